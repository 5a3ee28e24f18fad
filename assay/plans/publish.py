"""Validated publish: stage the batch, validate what was staged, gate, then
replace only the batch's own rows of the target.

* Staging and target are laid out by (bucket, day): ``bucket`` is a hash of the project, ``BUCKETS`` of them, so the
  number of folders does not depend on the number of projects.  Files are sorted by project, so a
  reader of one project opens one bucket and skips row groups (``read_published``).
* The batch is written once to a staging folder under the cluster's shared
  ``spark.checkpoint.dir`` (never a machine-local folder), rebalanced on its partitions first, so a bucket's day is a
  few files and a hot one is split.  That cuts the lineage: validation and publish read the staged files, a
  lost executor only recomputes staged tasks, and what was validated is what gets published.
* Many projects at once: the verdicts are a table; the staged rows are semi-joined to it, first on (bucket, day), which the
  reader turns into partitions to skip at run time, then on (project, day).  Nothing per batch comes to the driver.
* Results are written before the gate raises, so a failing run still leaves
  its results (and unexpected values) in the history.
* Publishing replaces the batch's days of its projects.  What a (bucket, day) folder holds of other projects is kept: the
  new folder is written whole beside the target first, then put in place by a dynamic partition
  overwrite, which can be repeated (``finish_publish``) if it broke off.  A day without rows is never
  published; what the target holds of it stays and the report names it.
* Staging is removed after a successful publish and kept after a failed one (it is
  the evidence); ``drop_staging`` removes it.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import BadParameter, CheckpointFailed
from ..functions import params as P
from ..operators.samples import unexpected_values
from ..session import checkpoint_root
from .by_day import stats_by_day, validate_by_day
from .checkpoint import CheckpointRun, RunIdentity, history_rows, run_checkpoint, write_history
from .suite import Suite

BUCKETS = 64
BUCKET = f"bucket_{BUCKETS}"     # the name says how many: a target with another number is refused
KEYS = (BUCKET, "dt")
STAGED_DAY = "staged_day"       # text, 'none' without a day: an equality that prunes needs a value


@dataclasses.dataclass
class PublishReport:
    target: str
    staging_path: str
    published_days: list[dt.date | None]
    failed_days: list[dt.date | None]
    identity: RunIdentity
    empty_days: list[dt.date] = dataclasses.field(default_factory=list)
    run: CheckpointRun | None = None
    rows_staged: int | None = None


def bucket_of(project: Column) -> Column:
    return F.pmod(F.xxhash64(project), F.lit(BUCKETS)).cast("int")


def _staged_day() -> Column:
    return F.coalesce(F.date_format("dt", "yyyy-MM-dd"), F.lit("none"))


def _write_partitioned(df: DataFrame, path: str, keys: Sequence[str], mode: str) -> None:
    """A few files per partition, sorted by project."""
    (df.hint("rebalance", *keys).sortWithinPartitions(*keys, "project")
     .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path))


def _staging_path(spark: SparkSession, staging_root: str | None, run_id: str | None = None) -> str:
    return f"{(staging_root or checkpoint_root(spark)).rstrip('/')}/assay-staging/{run_id or uuid.uuid4().hex}"


def stage_batch(batch: DataFrame, staging_root: str | None = None, run_id: str | None = None,
                observation: Observation | None = None) -> tuple[str, DataFrame]:
    """Write a batch with ``project`` and ``dt`` to ``<root>/assay-staging/<run_id>``, by bucket and day; read it back.

    The staged rows have two more columns, the bucket and the day as text, which partition them.
    ``observation`` collects the staged row count during the write (no extra job);
    it is for logging - the gate always reads the staged files.
    """
    spark = batch.sparkSession
    path = _staging_path(spark, staging_root, run_id)
    out = batch.observe(observation, F.count(F.lit(1)).alias("rows")) if observation else batch
    out = out.withColumn(BUCKET, bucket_of(F.col("project"))).withColumn(STAGED_DAY, _staged_day())
    _write_partitioned(out, path, (BUCKET, STAGED_DAY), "errorifexists")
    return path, spark.read.schema(out.schema).parquet(path)


def drop_staging(spark: SparkSession, path: str) -> None:
    """Delete a staging folder on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _observed_rows(observation: Observation) -> int | None:
    try:
        return int(observation.get["rows"])
    except Exception:  # noqa: BLE001 - logging only
        return None


def _read_target(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame | None:
    """The target's rows, or None if there is no target yet."""
    try:
        found = spark.read.parquet(target)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    if BUCKET not in found.columns:
        raise BadParameter(f"{target} is not laid out by {BUCKET}")
    return spark.read.schema(schema).parquet(target)


def _replace(rows: DataFrame, target: str, mine: Column, touched: Column, staging: str) -> None:
    """Put ``rows`` (with a bucket) in the place of the target's ``mine`` rows.

    ``touched`` selects the target's partitions that ``rows`` fall in, by their columns; what they hold beside ``mine`` stays.
    """
    spark = rows.sparkSession
    held = _read_target(spark, target, rows.schema)
    if held is None:    # nothing to keep: the staged files are copied as they are
        return _copy(rows, target)
    kept = held.where(touched & ~F.coalesce(mine, F.lit(False)))
    own = rows.select(*KEYS).distinct()     # a partition without new rows is left alone
    kept = kept.join(own, kept[BUCKET].eqNullSafe(own[BUCKET]) & kept["dt"].eqNullSafe(own["dt"]), "left_semi")
    rows = rows.unionByName(kept)
    merged = f"{staging}-merged"
    _write_partitioned(rows, merged, KEYS, "overwrite")
    finish_publish(spark, merged, target, rows.schema)


def _copy(rows: DataFrame, target: str) -> None:
    """Replace the partitions that ``rows`` fall in; no shuffle, files keep their order."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*KEYS).parquet(target)


def finish_publish(spark: SparkSession, merged: str, target: str, schema: T.StructType) -> None:
    """Copy whole partitions from ``merged`` into the target and drop them there; safe to repeat until it returns."""
    _copy(spark.read.schema(schema).parquet(merged), target)
    drop_staging(spark, merged)


def read_published(spark: SparkSession, target: str, project: str | None = None, begin: dt.date | str | None = None,
                   end: dt.date | str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Published rows, of one project (one bucket of folders, row groups by project) and a range of days.

    ``schema`` is that of the batches.  A target that no batch has passed into yet holds no file to take one from, so
    without it reading such a target is an error; with it, it has no rows.
    """
    reader = spark.read if schema is None else spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())]))
    df = reader.parquet(target)
    if project is not None:
        df = df.where((F.col(BUCKET) == bucket_of(F.lit(project))) & (F.col("project") == F.lit(project)))
    if begin is not None:
        df = df.where(F.col("dt") >= F.lit(P.parse_date(begin)))
    if end is not None:
        df = df.where(F.col("dt") <= F.lit(P.parse_date(end)))
    return df.drop(BUCKET)


def _with_project(batch: DataFrame, project: str) -> DataFrame:
    if not isinstance(project, str) or not project:
        raise BadParameter("publishing needs the batch's project: it is part of the target's key")
    return batch.withColumn("project", F.lit(project))


def publish_if_valid(batch: DataFrame, suite: Suite, target: str, params: Mapping | None = None,
                     failures_allowed: int = 0, history_path: str | None = None,
                     staging_root: str | None = None, data_dt: dt.date | str | None = None,
                     samples_path: str | None = None, *, project: str) -> PublishReport:
    """Publish the whole batch of ``project`` if the number of failed rules is within the limit."""
    obs = Observation("assay_staging")
    path, staged = stage_batch(_with_project(batch, project), staging_root, observation=obs)
    run = run_checkpoint(staged, suite, params, data_dt=data_dt, history_path=history_path, project=project)
    if run.stats["failed"] > failures_allowed:
        if samples_path:
            run.write_unexpected_values(samples_path)
        raise CheckpointFailed(run.stats["failed"], failures_allowed, run.run_name,
                               [r.asDict() for r in run.failed_expectations or []])
    days = [r.dt for r in staged.groupBy("dt").agg(F.count(F.lit(1)).alias("n")).collect()]  # the batch's days
    if days:
        _publish_days(staged, target, project, days, path)
    drop_staging(batch.sparkSession, path)
    return PublishReport(target, path, _in_order(days), [], run.identity, run=run, rows_staged=_observed_rows(obs))


def _in_order(days) -> list[dt.date | None]:
    return sorted(days, key=lambda d: (d is not None, d or dt.date.min))


def _any_of(groups: Sequence[tuple], names: Sequence[str]) -> Column:
    """TRUE for rows of one of the groups (a partition filter); NULL is a value like others."""
    if not groups:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [
        reduce(lambda a, b: a & b, [F.col(n).isNull() if v is None else F.col(n) == F.lit(v)
                                    for n, v in zip(names, g, strict=True)]) for g in groups])


def _publish_days(staged: DataFrame, target: str, project: str, days: list, staging: str) -> None:
    """Replace these days (of the batch's range) of one project."""
    mine = F.col("project").eqNullSafe(F.lit(project))
    touched = (F.col(BUCKET) == bucket_of(F.lit(project))) & _any_of([(d,) for d in days], ["dt"])
    _replace(staged.drop(STAGED_DAY), target, mine, touched, staging)


def batch_verdicts(staged: DataFrame, suite: Suite, begin: str | dt.date, end: str | dt.date,
                   params: Mapping | None = None) -> DataFrame:
    """(bucket, staged_day, project, dt, evaluated, failed, passed) of every (project, day) batch."""
    stats = stats_by_day(validate_by_day(staged, suite, begin, end, params, by=["project"]), ["project"])
    return stats.withColumn(BUCKET, bucket_of(F.col("project"))).withColumn(STAGED_DAY, _staged_day())


def passing_rows(staged: DataFrame, verdicts: DataFrame, failures_allowed: int = 0) -> DataFrame:
    """The staged rows whose batch passed, by two semi-joins to the table of verdicts.

    The first, on bucket and day, has ``BUCKETS`` rows a day at most on its small side, whatever the projects: that is what is
    broadcast, and the reader skips the other partitions.  The second decides per project and day; Spark picks how by its size.
    """
    good = verdicts.where(F.col("failed") <= F.lit(int(failures_allowed)))
    parts = good.select(BUCKET, STAGED_DAY).distinct()
    batches = good.select(F.col("project").alias("__project"), F.col(STAGED_DAY).alias("__day"))
    same = F.col("project").eqNullSafe(F.col("__project")) & (F.col(STAGED_DAY) == F.col("__day"))
    return staged.join(F.broadcast(parts), [BUCKET, STAGED_DAY], "left_semi").join(batches, same, "left_semi")


def _staged_verdicts(batch: DataFrame, suite: Suite, begin, end, params: Mapping | None, staging_root: str | None):
    spark = batch.sparkSession
    path, staged = stage_batch(batch, staging_root)
    rows = batch_verdicts(staged, suite, begin, end, params)
    rows.write.parquet(f"{path}-verdicts")
    return path, staged, spark.read.schema(rows.schema).parquet(f"{path}-verdicts")


def publishable_rows(batch: DataFrame, suite: Suite, begin: str | dt.date, end: str | dt.date,
                     failures_allowed: int = 0, params: Mapping | None = None,
                     staging_root: str | None = None) -> DataFrame:
    """The rows of the (project, day) batches, among many projects', whose own validation passes the gate.

    Stages the rows, validates every staged batch in one pass and reads the passing ones back.  The
    result reads the staged files, so they stay; ``publish_projects`` publishes them and cleans up.
    """
    _, staged, verdicts = _staged_verdicts(batch, suite, begin, end, params, staging_root)
    return passing_rows(staged, verdicts, failures_allowed).select(*batch.columns)


@dataclasses.dataclass
class ProjectsReport:
    target: str
    batches: int        # (project, day) batches with rows
    published: int
    failed: int


def publish_projects(batch: DataFrame, suite: Suite, target: str, begin: str | dt.date, end: str | dt.date,
                     failures_allowed: int = 0, params: Mapping | None = None, staging_root: str | None = None,
                     verdicts_path: str | None = None) -> ProjectsReport:
    """Publish the (project, day) batches, of any number of projects, that pass on their own; drop the staging.

    A batch that fails, or has no rows, is left as it is in the target.  ``verdicts_path`` keeps the verdicts (appended).
    """
    spark = batch.sparkSession
    b, e = P.date_range(begin, end)
    path, staged, verdicts = _staged_verdicts(batch, suite, b, e, params, staging_root)
    if verdicts_path:
        verdicts.drop(BUCKET, STAGED_DAY).write.mode("append").parquet(verdicts_path)
    rows = passing_rows(staged, verdicts, failures_allowed).select(*batch.columns, BUCKET)
    held = _read_target(spark, target, rows.schema)
    in_range = F.col("dt").between(F.lit(b), F.lit(e)) | F.col("dt").isNull()
    if held is None:
        _copy(rows, target)
    else:
        # other batches of the partitions that are replaced: not among those that are published
        out = rows.select("project", "dt").distinct().select(F.col("project").alias("__p"), F.col("dt").alias("__d"))
        parts = rows.select(*KEYS).distinct().select(F.col(BUCKET).alias("__b"), F.col("dt").alias("__t"))
        kept = held.where(in_range).join(F.broadcast(parts), (F.col(BUCKET) == F.col("__b")) & F.col("dt").eqNullSafe(F.col("__t")), "left_semi") \
            .join(out, F.col("project").eqNullSafe(F.col("__p")) & F.col("dt").eqNullSafe(F.col("__d")), "left_anti")
        _write_partitioned(rows.unionByName(kept), f"{path}-merged", KEYS, "overwrite")
        finish_publish(spark, f"{path}-merged", target, rows.schema)
    seen = staged.select("project", "dt").distinct().withColumn("__seen", F.lit(True))
    with_rows = verdicts.join(seen, verdicts["project"].eqNullSafe(seen["project"]) & verdicts["dt"].eqNullSafe(seen["dt"]), "left_semi")
    n, good = with_rows.agg(F.count(F.lit(1)), F.count_if(F.col("failed") <= F.lit(int(failures_allowed)))).first()
    drop_staging(spark, path)
    drop_staging(spark, f"{path}-verdicts")
    return ProjectsReport(target, n, good, n - good)


def publish_by_day(batch: DataFrame, suite: Suite, target: str, begin: str | dt.date, end: str | dt.date,
                   failures_allowed: int = 0, params: Mapping | None = None,
                   history_path: str | None = None, staging_root: str | None = None,
                   raise_on_failure: bool = True, samples_path: str | None = None, *, project: str) -> PublishReport:
    """Backfill of ``project``: validate every day in one pass, publish the days that pass.

    Failing days are left as they are in the target; with ``raise_on_failure``
    the call raises after the passing days are published.
    """
    b, e = P.date_range(begin, end)
    path, staged = stage_batch(_with_project(batch, project), staging_root)
    # Evaluate once: one row per (day, rule), bounded by the range; history and gate use the rows.
    rows = validate_by_day(staged, suite, b, e, params).collect()
    identity = RunIdentity.new(suite.name, project)
    spark = staged.sparkSession
    if history_path:
        write_history(history_rows(spark, identity, [(r.dt, r) for r in rows]), history_path)
    failed: dict[dt.date | None, int] = {}
    counted: dict[dt.date | None, int] = {}
    for r in rows:
        failed[r.dt] = failed.get(r.dt, 0) + (0 if r.success else 1)
        counted[r.dt] = r.element_count
    good = _in_order(d for d, n in failed.items() if n <= failures_allowed and counted[d])
    bad = _in_order(d for d, n in failed.items() if n > failures_allowed)
    if bad and samples_path:
        _write_day_values(staged, suite, rows, bad, params, samples_path, identity)
    if good:
        _publish_days(staged.where(_any_of([(d,) for d in good], ["dt"])), target, project, good, path)
    report = PublishReport(target, path, good, bad, identity, [d for d, n in counted.items() if not n])
    if bad and raise_on_failure:
        failures = [r.asDict() for r in rows if not r.success and r.dt in set(bad)]
        raise CheckpointFailed(max(failed.values()), failures_allowed,
                               f"{identity.run_name}, days {', '.join(map(str, bad))}", failures)
    if not bad:
        drop_staging(spark, path)
    return report


def _write_day_values(staged: DataFrame, suite: Suite, rows, bad: list, params: Mapping | None,
                      samples_path: str, identity: RunIdentity) -> None:
    """All unexpected values of the failed (day, rule) pairs: one pass over the failing days, for rules that failed."""
    pairs = sorted({(r.dt, r.rule_id) for r in rows if not r.success and r.dt in set(bad)}, key=str)
    failed_rules = {i for _, i in pairs}
    run_params = P.merge_params(P.merge_params(suite.params, params), P.day_params("dt"))
    values = unexpected_values(staged.where(_any_of([(d,) for d in bad], ["dt"])),
                               [(i, r) for i, r in suite.numbered() if i in failed_rules], run_params, group_cols=["dt"])
    if values is None:
        return
    # failed (day, rule) pairs: at most days x rules rows, a bounded broadcast
    schema = T.StructType([T.StructField("day", T.DateType()), T.StructField("rule", T.IntegerType())])
    wanted = staged.sparkSession.createDataFrame(pairs, schema)
    (values.join(F.broadcast(wanted), F.col("dt").eqNullSafe(F.col("day")) & (F.col("rule_id") == F.col("rule")), "left_semi")
     .withColumnRenamed("dt", "data_dt")
     .select(F.lit(identity.project).alias("project"), F.lit(identity.run_id).alias("run_id"), "*")
     .write.mode("append").parquet(samples_path))
