"""Extract one batch: project + inclusive UTC date range -> flat 12-column rows.

The filter is written on the source columns before the projection, and the date
range is expressed on the raw timestamp (``ts >= begin 00:00 AND ts < end+1 00:00``),
which equals ``to_date(ts) BETWEEN begin AND end`` and is pushed into the Parquet
scan together with the nested ``file.project`` equality.  If the source is itself
partitioned by ``dt``, the same range is also put on ``dt`` so folders are pruned.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import params as P
from ..functions import sqltext as S
from ..session import require_utc
from ..sources.downloads import check_source_schema

# Fixed values (must equal the reference's select list): batch column -> source expression, in order.
BATCH_FIELDS = {
    "download_time": "timestamp",
    "country_code": "country_code",
    "file_type": "file.type",
    "pkg_version": "file.version",
    "python_version": "coalesce(details.python, details.implementation.version)",
    "installer_name": "details.installer.name",
    "installer_version": "details.installer.version",
    "distro_name": "details.distro.name",
    "distro_version": "details.distro.version",
    "system_name": "details.system.name",
    "system_version": "details.system.release",
    "dt": "to_date(timestamp)",
}
BATCH_COLUMNS = tuple(BATCH_FIELDS)
_SELECT_LIST = [f"{path} AS {name}" for name, path in BATCH_FIELDS.items()]


def _ts_type(src: DataFrame) -> T.DataType:
    return src.schema["timestamp"].dataType


def flatten(src: DataFrame, *extra: Column) -> DataFrame:
    """Nested source -> flat batch (renames, struct fields, coalesce, UTC date).

    A field under a NULL parent struct is NULL.  Projection only: no shuffle.
    ``extra`` columns are carried after the batch columns.
    """
    if isinstance(_ts_type(src), T.TimestampType):
        require_utc(src.sparkSession)
    return src.select(*[F.expr(x) for x in _SELECT_LIST], *extra)


def project_filter(project: str) -> Column:
    """``file.project = <project>``; the value is a bound literal, never SQL text."""
    if not isinstance(project, str):
        raise P.BadParameter(f"project must be a string, got {project!r}")
    return F.col("file.project") == F.lit(project)


def date_filter(src: DataFrame, begin: str | dt.date, end: str | dt.date) -> Column:
    """UTC days ``begin..end`` inclusive, as a half-open range on the raw timestamp."""
    b, e = P.date_range(begin, end)
    ts_type = _ts_type(src)
    if isinstance(ts_type, T.TimestampType):
        require_utc(src.sparkSession)
    lo = F.expr(S.typed_lit(dt.datetime.combine(b, dt.time()), ts_type))
    hi = F.expr(S.typed_lit(dt.datetime.combine(e + P.ONE_DAY, dt.time()), ts_type))
    cond = (F.col("timestamp") >= lo) & (F.col("timestamp") < hi)
    if "dt" in src.columns:  # partitioned source: prune dt folders too
        cond = cond & F.col("dt").between(F.lit(b.isoformat()).cast("date"), F.lit(e.isoformat()).cast("date"))
    return cond


def extract_batch(src: DataFrame, project: str, begin: str | dt.date, end: str | dt.date) -> DataFrame:
    """The batch of one project over an inclusive date range (reversed range raises)."""
    check_source_schema(src)
    return flatten(src.where(project_filter(project) & date_filter(src, begin, end)))


EXTRACT_SQL = f"""
SELECT {", ".join(_SELECT_LIST)}
FROM {{src}}
WHERE file.project = :project
  AND to_date(timestamp) BETWEEN :begin AND :end
"""

# Added when the source is partitioned by dt, so its folders are pruned too.
EXTRACT_SQL_DT = "\n  AND dt BETWEEN :begin AND :end\n"


def extract_batch_sql(spark: SparkSession, src: DataFrame, project: str,
                      begin: str | dt.date, end: str | dt.date) -> DataFrame:
    """SQL form of ``extract_batch`` with named parameter markers (no string splicing)."""
    check_source_schema(src)
    b, e = P.date_range(begin, end)
    if isinstance(_ts_type(src), T.TimestampType):
        require_utc(spark)
    query = EXTRACT_SQL.rstrip("\n") + (EXTRACT_SQL_DT if "dt" in src.columns else "\n")
    return spark.sql(query, args={"project": project, "begin": b, "end": e}, src=src)
