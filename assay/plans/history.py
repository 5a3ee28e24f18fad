"""Result history at scale: appended in one job for many batches, compacted safely.

Every run appends its rows to the history (``checkpoint.write_history``): a file per run and day, never fewer.
``compact_history`` rewrites the days that have more than ``max_files`` files.  Parquet has no transaction over folders, so it
works in two steps that can be repeated: the compacted days are written whole to a folder beside the history, which is complete when its
``_SUCCESS`` is there, then they replace the days by a dynamic partition overwrite, and the folder goes.  If that breaks off, the next
call finds the folder and starts from the rows of both, each once; a row is known by its run, rule and day.
One writer at a time, as everywhere on plain Parquet.
"""

from __future__ import annotations

import dataclasses

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metrics import RESULT_COLUMNS
from .checkpoint import HISTORY_SCHEMA, RunIdentity
from .publish import drop_staging

DAY = "data_dt"
#: What makes a row of the history one row.
ROW_KEY = ("project", "suite_name", "run_id", DAY, "rule_id")


def append_results(results: DataFrame, suite_name: str, path: str) -> RunIdentity:
    """Append the results of many (project, day) batches as one run; nothing comes to the driver."""
    run = RunIdentity.new(suite_name)
    rows = results.select(
        "project", F.lit(run.suite_name).alias("suite_name"), F.lit(run.run_id).alias("run_id"), F.lit(run.run_name).alias("run_name"),
        F.lit(run.run_time.date()).alias("run_dt"), *RESULT_COLUMNS, F.col("dt").alias(DAY))
    rows.hint("rebalance", DAY).write.mode("append").partitionBy(DAY).parquet(path)
    return run


@dataclasses.dataclass
class CompactReport:
    days: int           # rewritten
    files_before: int   # of those days
    resumed: bool       # a compaction that broke off was finished first


def _side(path: str) -> str:
    return f"{path.rstrip('/')}-compacting"


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        spark.read.text(f"{path}/_SUCCESS")     # written last: without it the folder is not whole
        return spark.read.schema(HISTORY_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _crowded(history: DataFrame, max_files: int) -> DataFrame:
    """(day, files) of the days with more than ``max_files`` files; the files are counted, not listed on the driver."""
    files = history.select(DAY, F.input_file_name().alias("file")).distinct()
    return files.groupBy(DAY).agg(F.count(F.lit(1)).alias("files")).where(F.col("files") > max_files)


def compact_history(spark: SparkSession, path: str, max_files: int = 1) -> CompactReport:
    """Rewrite the days that are in more than ``max_files`` files; the same rows, about one file a day."""
    side, resumed = _side(path), False
    half_done = _read_or_none(spark, side)
    if half_done is not None:
        # days of the folder, and what was appended to them since
        days = half_done.select(DAY).distinct()
        now = spark.read.schema(HISTORY_SCHEMA).parquet(path)
        again = now.join(F.broadcast(days.withColumnRenamed(DAY, "d")), F.col(DAY).eqNullSafe(F.col("d")), "left_semi")  # a row a day
        both = half_done.unionByName(again).dropDuplicates(list(ROW_KEY))
        _write_days(both, f"{side}-resumed", "overwrite")
        _put(spark, f"{side}-resumed", path)
        drop_staging(spark, side)
        resumed = True
    else:
        drop_staging(spark, side)       # not whole: the history still has every row
    history = spark.read.schema(HISTORY_SCHEMA).parquet(path)
    crowded = _crowded(history, max_files)
    n, files = crowded.agg(F.count(F.lit(1)), F.sum("files")).first()
    if n:
        rows = history.join(F.broadcast(crowded.select(F.col(DAY).alias("d"))), F.col(DAY).eqNullSafe(F.col("d")), "left_semi")
        _write_days(rows, side, "errorifexists")
        _put(spark, side, path)
    return CompactReport(n, files or 0, resumed)


def _write_days(rows: DataFrame, path: str, mode: str) -> None:
    rows.hint("rebalance", DAY).sortWithinPartitions(DAY, "project", "suite_name", "run_id", "rule_id") \
        .write.mode(mode).partitionBy(DAY).parquet(path)


def _put(spark: SparkSession, side: str, path: str) -> None:
    """Replace the days of the history by those of a whole folder, then drop the folder."""
    spark.read.schema(HISTORY_SCHEMA).parquet(side).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(DAY).parquet(path)
    drop_staging(spark, side)
