"""Footer audit of declared reads."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from assay.errors import SchemaDriftError
from assay.sources.audit import audit_files, check_files, problems_of
from assay.sources.downloads import downloads_schema, read_downloads


@pytest.fixture()
def source(spark, scratch, source001):
    path = f"{scratch}/downloads"
    source001.withColumn("dt", F.to_date("timestamp")).write.partitionBy("dt").parquet(path)
    return path


def schema_of(source):
    from pyspark.sql import types as T
    return downloads_schema(T.TimestampNTZType())


def test_good_files_pass(spark, source):
    assert audit_files(spark, source).count() == 0
    check_files(spark, source)
    df = read_downloads(spark, source, schema=schema_of(source))
    assert df.count() == spark.read.parquet(source).count()


def test_a_file_without_a_field_is_named(spark, source):
    """One file of many lacks details.distro: the declared read would answer NULL."""
    odd = spark.read.parquet(source).drop("dt").limit(5).withColumn("details", F.col("details").dropFields("distro"))
    odd.coalesce(1).write.mode("append").parquet(f"{source}/dt=2024-01-02")
    found = audit_files(spark, source).collect()
    assert {r.field for r in found} == {"details.distro.name", "details.distro.version"}
    assert len({r.file for r in found}) == 1 and "dt=2024-01-02" in found[0].file and {r.problem for r in found} == {"missing"}
    with pytest.raises(SchemaDriftError, match=r"dt=2024-01-02/part-.*details.distro.name missing"):
        read_downloads(spark, source, schema=schema_of(source))
    blind = read_downloads(spark, source, schema=schema_of(source), audit=False)
    assert blind.count() == spark.read.schema(schema_of(source)).parquet(source).count()


def test_other_types_and_broken_files(spark, source):
    spark.read.parquet(source).drop("dt").limit(3).withColumn("country_code", F.lit(7)).withColumn("file", F.lit("x")) \
        .coalesce(1).write.mode("append").parquet(f"{source}/dt=2024-01-03")
    with open(os.path.join(source, "dt=2024-01-04", "broken.parquet"), "wb") as f:
        f.write(b"PAR1 not really")
    found = {(r.field, r.problem.split(":")[0]) for r in audit_files(spark, source).collect()}
    assert found == {("country_code", "is int32"), ("file.project", "missing"), ("file.type", "missing"), ("file.version", "missing"),
                     (None, "unreadable")}
    with pytest.raises(SchemaDriftError):
        check_files(spark, source)


def test_names_with_spaces_and_an_opener(spark, scratch):
    os.makedirs(f"{scratch}/a b=1")
    pq.write_table(pa.table({"country_code": ["x"]}), f"{scratch}/a b=1/one.parquet")
    fields = {"country_code": (), "nope": ()}
    assert [(r.field, r.problem) for r in audit_files(spark, scratch, fields).collect()] == [("nope", "missing")]

    def opener(path):
        return open(path.removeprefix("file:").replace("%20", " "), "rb")
    assert audit_files(spark, scratch, fields, opener).count() == 1


def test_dictionary_and_zoned_columns():
    names = {"a": ("StringType",), "t": ("TimestampType",), "u": ("TimestampNTZType",), "s.x": ("StringType",)}
    schema = pa.schema([("a", pa.dictionary(pa.int32(), pa.string())), ("t", pa.timestamp("us", "UTC")), ("u", pa.timestamp("ns")),
                        ("s", pa.struct([("x", pa.large_string())]))])
    assert problems_of(schema, names) == []
    assert problems_of(pa.schema([("a", pa.int64()), ("s", pa.string())]), names) == [
        ("a", "is int64"), ("t", "missing"), ("u", "missing"), ("s.x", "missing")]
