"""The nested package-downloads fact table.

Source layout (only the fields the extract uses)::

    timestamp     timestamp (UTC instant) or timestamp_ntz
    country_code  string
    file          struct<project, type, version: string>
    details       struct<python: string,
                         implementation: struct<version>,
                         installer: struct<name, version>,
                         distro: struct<name, version>,
                         system: struct<name, release>>

``downloads_from_events`` derives such a table from the ``events`` table so the
whole pipeline can run on the test data (one download per event).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SchemaDriftError

# Field path -> accepted Spark types.  Only these fields are read.
TIMESTAMP_TYPES = (T.TimestampType, T.TimestampNTZType)
DOWNLOADS_FIELDS: dict[str, tuple[type, ...]] = {
    "timestamp": TIMESTAMP_TYPES,
    "country_code": (T.StringType,),
    "file.project": (T.StringType,),
    "file.type": (T.StringType,),
    "file.version": (T.StringType,),
    "details.python": (T.StringType,),
    "details.implementation.version": (T.StringType,),
    "details.installer.name": (T.StringType,),
    "details.installer.version": (T.StringType,),
    "details.distro.name": (T.StringType,),
    "details.distro.version": (T.StringType,),
    "details.system.name": (T.StringType,),
    "details.system.release": (T.StringType,),
}


def downloads_schema(timestamp_type: T.DataType | None = None) -> T.StructType:
    """The source layout as a declared schema (``timestamp`` is an instant unless told otherwise).

    Reading with it needs no look at the files and reads only these fields; a file
    that lacks one gives NULL, so ``read_downloads`` audits the files' footers as well.
    """
    def build(paths: dict[str, T.DataType]) -> T.StructType:
        out = T.StructType()
        for name in dict.fromkeys(p.split(".", 1)[0] for p in paths):
            below = {p.split(".", 1)[1]: t for p, t in paths.items() if p.startswith(name + ".")}
            out.add(name, build(below) if below else paths[name])
        return out

    return build({path: (timestamp_type or T.TimestampType()) if path == "timestamp" else T.StringType()
                  for path in DOWNLOADS_FIELDS})


def _field_type(schema: T.StructType, path: str) -> T.DataType | None:
    dtype: T.DataType = schema
    for part in path.split("."):
        if not isinstance(dtype, T.StructType) or part not in dtype.fieldNames():
            return None
        dtype = dtype[part].dataType
    return dtype


def check_source_schema(df: DataFrame, fields: dict[str, tuple[type, ...]] = DOWNLOADS_FIELDS) -> None:
    """Fail early when a needed nested field is missing or has another type."""
    problems = []
    for path, accepted in fields.items():
        dtype = _field_type(df.schema, path)
        if dtype is None:
            problems.append(f"{path}: missing")
        elif not isinstance(dtype, accepted):
            problems.append(f"{path}: {dtype.simpleString()}")
    if problems:
        raise SchemaDriftError("downloads source schema drift: " + "; ".join(problems))


def read_downloads(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                   table: str | None = None, schema: T.StructType | None = None, audit: bool | None = None) -> DataFrame:
    """Read a nested downloads table (files at ``path``, or a catalog ``table``) and check its schema.

    ``schema`` (see ``downloads_schema``) is declared to the reader; without it the
    files' own schema is taken.  A declared schema would hide files that lack a field, so the footers of Parquet files
    are audited then (``audit.check_files``); ``audit`` turns that on or off.

    Nothing is selected here: the extract's projection and filters are pushed into
    the scan by Catalyst (nested ``ReadSchema`` pruning, ``PushedFilters``).
    """
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path or table")
    if audit if audit is not None else schema is not None and path is not None and fmt == "parquet":
        if path is None or fmt != "parquet":
            raise ValueError("an audit needs Parquet files at a path")
        from .audit import check_files
        check_files(spark, path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = spark.table(table) if table else reader.format(fmt).load(path)
    check_source_schema(df)
    return df


def _when_not(cond: Column, value: str) -> Column:
    return F.when(~cond, F.lit(value))


def downloads_from_events(events: DataFrame, null_keys: bool = False) -> DataFrame:
    """Nested downloads rows derived from ``events`` (one row per event).

    ``id`` is ``event_id``.  With ``null_keys`` timestamp is NULL when id%101=0 and
    file.project when id%97=0 (rows of no day or no project).  country: id%200=0 -> 'QQ', id%100=50 -> NULL,
    id%3=0 -> 'US', else 'DE'.  file.project = event_type; file.type:
    id%4=0 -> 'sdist' else 'bdist_wheel'; file.version = "id%3.id%120.id%10".
    details is NULL when id%50=0; inside it python is NULL when id%5=0,
    implementation.version NULL when id%25=0, the installer NULL when id%6=0,
    distro.name 'Ubuntu' for even ids else 'Debian'.  A projection only: no shuffle.
    """
    i = F.col("event_id")
    details = F.struct(
        _when_not(i % 5 == 0, "3.10").alias("python"),
        F.struct(_when_not(i % 25 == 0, "3.9").alias("version")).alias("implementation"),
        F.when(
            i % 6 != 0, F.struct(F.lit("pip").alias("name"), F.lit("23.0").alias("version"))
        ).alias("installer"),
        F.struct(
            F.when(i % 2 == 0, "Ubuntu").otherwise("Debian").alias("name"),
            F.lit("22.04").alias("version"),
        ).alias("distro"),
        F.struct(F.lit("Linux").alias("name"), F.lit("5.4").alias("release")).alias("system"),
    )
    return events.select(
        (F.when(i % 101 != 0, F.col("ts")) if null_keys else F.col("ts")).alias("timestamp"),
        F.when(i % 200 == 0, "QQ")
        .when(i % 100 == 50, F.lit(None).cast("string"))
        .when(i % 3 == 0, "US")
        .otherwise("DE")
        .alias("country_code"),
        F.struct(
            (F.when(i % 97 != 0, F.col("event_type")) if null_keys else F.col("event_type")).alias("project"),
            F.when(i % 4 == 0, "sdist").otherwise("bdist_wheel").alias("type"),
            F.concat_ws(".", (i % 3).cast("string"), (i % 120).cast("string"), (i % 10).cast("string")).alias("version"),
        ).alias("file"),
        F.when(i % 50 != 0, details).alias("details"),
    )
