"""Footer audit: which files of a Parquet source lack a field, or have it in another type.

A read with a declared schema answers NULL for a field that a file lacks, so the schema of the DataFrame says nothing about the
files.  The audit looks at the files themselves: Spark lists them, tasks read the footers (a few KB a file, no rows) and compare
them with the declared fields; only findings come back.

Tasks open files through ``pyarrow.fs`` by their full path (file, hdfs, s3, gs and so on).  A store that only Spark can open
needs an ``opener``: a function from the path to something ``pyarrow.parquet.ParquetFile`` takes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SchemaDriftError
from .downloads import DOWNLOADS_FIELDS

FINDINGS = "file string, field string, problem string"
NAMED = 20      # findings that an error message lists; the table has them all
FILES_PER_TASK = 500


def _kind(t: pa.DataType) -> str:
    """The Spark type that a file's type is read as, as far as the audit tells types apart."""
    if pa.types.is_dictionary(t):
        return _kind(t.value_type)
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return T.StringType.__name__
    if pa.types.is_timestamp(t):
        return T.TimestampType.__name__ if t.tz else T.TimestampNTZType.__name__
    return str(t)


def problems_of(schema: pa.Schema, fields: dict[str, tuple[str, ...]]) -> list[tuple[str, str]]:
    """(field path, problem) of a file's schema; ``fields`` gives the names of the accepted Spark types."""
    out = []
    for path, accepted in fields.items():
        found: pa.Schema | pa.DataType = schema
        for part in path.split("."):
            at = found.get_field_index(part) if isinstance(found, pa.Schema) or pa.types.is_struct(found) else -1
            if at < 0:
                out.append((path, "missing"))
                break
            found = found.field(at).type
        else:
            if accepted and _kind(found) not in accepted:
                out.append((path, f"is {found}"))
    return out


def _read_schema(path: str, opener: Callable | None) -> pa.Schema:
    import pyarrow.parquet as pq
    from pyarrow import fs

    if opener is not None:
        return pq.ParquetFile(opener(path)).schema_arrow
    if path.startswith("file:"):
        return pq.read_schema(unquote(path.removeprefix("file:").replace("//", "/", 1)))
    system, name = fs.FileSystem.from_uri(path)
    return pq.read_schema(name, filesystem=system)


def audit_files(spark: SparkSession, path: str, fields: dict[str, tuple[type, ...]] = DOWNLOADS_FIELDS,
                opener: Callable | None = None) -> DataFrame:
    """``file, field, problem`` of every Parquet file below ``path`` that lacks a field, has it in another type, or has no footer."""
    names = {p: tuple(t.__name__ for t in types) for p, types in fields.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for file in batch.column(0).to_pylist():
                try:
                    out += [(file, f, p) for f, p in problems_of(_read_schema(file, opener), names)]
                except (pa.ArrowInvalid, OSError) as e:
                    out.append((file, None, f"unreadable: {str(e)[:200]}"))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], names=["file", "field", "problem"])

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet") \
        .load(path).select("path")      # the listing alone: no file is opened
    n = listed.count()
    return listed.repartition(max(1, -(-n // FILES_PER_TASK)), F.xxhash64("path")).mapInArrow(run, FINDINGS)


def check_files(spark: SparkSession, path: str, fields: dict[str, tuple[type, ...]] = DOWNLOADS_FIELDS, opener: Callable | None = None) -> None:
    """Raise ``SchemaDriftError`` that names files and fields, if any file lacks a field or has it in another type."""
    found = audit_files(spark, path, fields, opener)
    some = found.orderBy("file", "field").limit(NAMED + 1).collect()
    if some:
        lines = [f"{r.file}: {r.field or 'file'} {r.problem}" for r in some[:NAMED]]
        more = ["and more"] if len(some) > NAMED else []
        raise SchemaDriftError("files that differ from the declared schema: " + "; ".join(lines + more))
