"""Checkpoint: run a suite on a batch, keep the results, summarise and gate.

``validate`` is lazy: a results DataFrame (one row per rule) whose evaluation is
one fused aggregate job plus one mode job.  ``run_checkpoint`` evaluates it once
(the result has one row per rule, bounded by the suite), adds the run identity,
and gives statistics, failures, samples and the gate from those rows.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import CheckpointFailed
from ..functions import params as P
from ..operators.metrics import RESULT_COLUMNS, RESULT_SCHEMA, suite_results
from ..operators.samples import top_values, unexpected_values
from .suite import Suite


# One row shape for every run, whole batch or per day: who, when, which data, then the rule's result.
HISTORY_SCHEMA = T.StructType([
    T.StructField("project", T.StringType(), True),
    T.StructField("suite_name", T.StringType(), False),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("run_name", T.StringType(), False),
    T.StructField("run_dt", T.DateType(), False),
    *RESULT_SCHEMA.fields,
    T.StructField("data_dt", T.DateType(), True),
])
RUN_KEYS = ("project", "suite_name", "run_id", "run_name", "run_dt", "data_dt")


@dataclasses.dataclass(frozen=True)
class RunIdentity:
    """What names a run in results, history and listings."""

    suite_name: str
    run_id: str
    run_name: str
    run_time: dt.datetime
    project: str | None = None

    @classmethod
    def new(cls, suite_name: str, project: str | None = None, run_time: dt.datetime | None = None) -> "RunIdentity":
        run_time = run_time or dt.datetime.now(dt.timezone.utc)
        return cls(suite_name, uuid.uuid4().hex, run_name_for(suite_name, run_time), run_time, project)


def history_rows(spark: SparkSession, run: RunIdentity, rows: Sequence[tuple[dt.date | None, Row]]) -> DataFrame:
    """(data day, result row) pairs of a run as history rows."""
    head = (run.project, run.suite_name, run.run_id, run.run_name, run.run_time.date())
    return spark.createDataFrame([(*head, *[r[c] for c in RESULT_COLUMNS], day) for day, r in rows], HISTORY_SCHEMA)


def write_history(history: DataFrame, path: str) -> None:
    """Append a run's rows (rules x days) to the history table, partitioned by ``data_dt``."""
    history.coalesce(1).write.mode("append").partitionBy("data_dt").parquet(path)


def validate(batch: DataFrame, suite: Suite, params: Mapping | None = None,
             group_cols: Sequence[str] = (), days: tuple[str, Column] | None = None, one_scan: bool | None = None) -> DataFrame:
    """Lazy results of every rule of ``suite`` on ``batch`` (run-time params win).

    With ``group_cols`` every group of rows is its own batch (e.g. one per project,
    or per project and day), all validated in the same one or two scans (``one_scan``).
    """
    merged = P.merge_params(suite.params, params)
    if not suite.rules:
        raise ValueError(f"suite {suite.name!r} has no rules")
    res = suite_results(batch, suite.numbered(), merged, group_cols, days, one_scan)
    return res.select(*group_cols, *RESULT_COLUMNS)


def run_stats(results: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """evaluated / failed / passed per run (or per group, e.g. per day)."""
    keys = list(group_cols)
    agg = [F.count(F.lit(1)).alias("evaluated"), F.count_if(~F.col("success")).alias("failed")]
    stats = results.groupBy(*keys).agg(*agg) if keys else results.agg(*agg)
    return stats.withColumn("passed", F.col("evaluated") - F.col("failed"))


def failed_expectations(results: DataFrame) -> DataFrame:
    return results.where(~F.col("success"))


def gate_status(stats: DataFrame, failures_allowed: int = 0) -> DataFrame:
    """The gate as data: ``gate_passed`` = failed <= allowed."""
    return stats.withColumn("failures_allowed", F.lit(int(failures_allowed))) \
        .withColumn("gate_passed", F.col("failed") <= F.col("failures_allowed"))


@dataclasses.dataclass
class CheckpointRun:
    """One evaluated run of a suite on a batch."""

    batch: DataFrame
    suite: Suite
    params: dict
    identity: RunIdentity
    data_dt: dt.date | None
    rows: list[Row]

    @property
    def run_id(self) -> str:
        return self.identity.run_id

    @property
    def run_name(self) -> str:
        return self.identity.run_name

    @property
    def results(self) -> DataFrame:
        """Results with the run identity, as a DataFrame (built from the evaluated rows)."""
        return history_rows(self.batch.sparkSession, self.identity, [(self.data_dt, r) for r in self.rows])

    @property
    def stats(self) -> dict[str, int]:
        evaluated = len(self.rows)
        failed = sum(1 for r in self.rows if not r.success)
        return {"evaluated": evaluated, "failed": failed, "passed": evaluated - failed}

    @property
    def failed_expectations(self) -> list[Row] | None:
        failed = [r for r in self.rows if not r.success]
        return failed or None

    def check_results(self, failures_allowed: int = 0) -> str:
        """Raise ``CheckpointFailed`` if more rules failed than allowed."""
        failed = self.stats["failed"]
        if failed > failures_allowed:
            raise CheckpointFailed(failed, failures_allowed, self.run_name,
                                   [r.asDict() for r in self.failed_expectations or []])
        return f"gate open: {failed} rules failed, the limit is {failures_allowed}"

    def unexpected_values(self) -> DataFrame | None:
        """Every unexpected value of each failed row-level rule, counted (one pass over the batch)."""
        failed_ids = {r.rule_id for r in self.rows if not r.success}
        rules = [(i, r) for i, r in self.suite.numbered() if i in failed_ids]
        return unexpected_values(self.batch, rules, self.params) if rules else None

    def samples(self, k: int) -> DataFrame | None:
        """The ``k`` most frequent rows of ``unexpected_values`` per rule."""
        values = self.unexpected_values()
        return None if values is None else top_values(values, k)

    def write_unexpected_values(self, path: str) -> None:
        """Append all unexpected values, with the run's identity, to a table."""
        values = self.unexpected_values()
        if values is not None:
            values.select(F.lit(self.identity.project).cast("string").alias("project"), F.lit(self.run_id).alias("run_id"),
                          F.lit(self.data_dt).cast("date").alias("data_dt"), "*").write.mode("append").parquet(path)

    def list_failures(self) -> list[str]:
        failed = self.failed_expectations
        if not failed:
            return ["every rule passed"]
        return [str(r.asDict()) for r in failed]

    def write_history(self, path: str) -> None:
        write_history(self.results, path)


def run_name_for(suite_name: str, run_time: dt.datetime) -> str:
    return f"{run_time:%Y-%m-%d}_{suite_name}"


def run_checkpoint(batch: DataFrame, suite: Suite, params: Mapping | None = None,
                   data_dt: dt.date | str | None = None, run_time: dt.datetime | None = None,
                   history_path: str | None = None, project: str | None = None) -> CheckpointRun:
    """Evaluate the suite once and return the run (results are one row per rule)."""
    # One row per rule: bounded by the suite, never by the data (sorted here, not by a Spark sort).
    rows = sorted(validate(batch, suite, params).collect(), key=lambda r: r.rule_id)
    run = CheckpointRun(
        batch=batch, suite=suite, params=P.merge_params(suite.params, params),
        identity=RunIdentity.new(suite.name, project, run_time),
        data_dt=P.parse_date(data_dt) if isinstance(data_dt, str) else data_dt, rows=rows,
    )
    if history_path:
        run.write_history(history_path)
    return run


def read_history(spark, path: str, begin: dt.date | str | None = None, end: dt.date | str | None = None,
                 suite_name: str | None = None, project: str | None = None) -> DataFrame:
    """Stored rule results, optionally for a range of data dates (``data_dt`` folders are pruned)."""
    df = spark.read.schema(HISTORY_SCHEMA).parquet(path)
    if begin is not None:
        df = df.where(F.col("data_dt") >= F.lit(P.parse_date(begin).isoformat()).cast("date"))
    if end is not None:
        df = df.where(F.col("data_dt") <= F.lit(P.parse_date(end).isoformat()).cast("date"))
    if suite_name is not None:
        df = df.where(F.col("suite_name") == F.lit(suite_name))
    if project is not None:
        df = df.where(F.col("project") == F.lit(project))
    return df


def run_summaries(history: DataFrame) -> DataFrame:
    """One record per run and data day: evaluated / failed / passed and whether every rule passed."""
    return run_stats(history, RUN_KEYS).withColumn("success", F.col("failed") == 0)
