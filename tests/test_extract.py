import datetime as dt

import pytest
from pyspark.sql import types as T

from assay import BadParameter, SchemaDriftError, SessionConfigError, extract_batch, extract_batch_sql, flatten
from assay.operators.extract import BATCH_COLUMNS
from assay.functions.params import default_query_date, instant_bounds, parse_date

DETAILS = T.StructType([
    T.StructField("python", T.StringType()),
    T.StructField("implementation", T.StructType([T.StructField("version", T.StringType())])),
    T.StructField("installer", T.StructType([T.StructField("name", T.StringType()), T.StructField("version", T.StringType())])),
    T.StructField("distro", T.StructType([T.StructField("name", T.StringType()), T.StructField("version", T.StringType())])),
    T.StructField("system", T.StructType([T.StructField("name", T.StringType()), T.StructField("release", T.StringType())])),
])
SOURCE = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("file", T.StructType([T.StructField(n, T.StringType()) for n in ("project", "type", "version")])),
    T.StructField("details", DETAILS),
])


def _src(spark, rows):
    return spark.createDataFrame(rows, SOURCE)


def _utc(*a):
    return dt.datetime(*a, tzinfo=dt.timezone.utc)


def _details(python="3.10", impl="3.9"):
    return (python, (impl,), ("pip", "23.0"), ("Ubuntu", "22.04"), ("Linux", "5.4"))


def test_flatten_schema_and_null_parent(spark):
    src = _src(spark, [(_utc(2024, 1, 1, 1), "US", ("p", "sdist", "1.0.0"), None)])
    row = flatten(src).collect()[0]
    assert list(flatten(src).columns) == list(BATCH_COLUMNS)
    for c in ("python_version", "installer_name", "installer_version", "distro_name",
              "distro_version", "system_name", "system_version"):
        assert row[c] is None


def test_coalesce_python_version(spark):
    src = _src(spark, [
        (_utc(2024, 1, 1), "US", ("p", "sdist", "1"), _details(None, "3.9")),
        (_utc(2024, 1, 1), "US", ("p", "sdist", "1"), _details("3.11", "3.9")),
        (_utc(2024, 1, 1), "US", ("p", "sdist", "1"), _details(None, None)),
    ])
    assert [r.python_version for r in flatten(src).collect()] == ["3.9", "3.11", None]


def test_zone_utc_date(spark):
    src = _src(spark, [(_utc(2023, 1, 2, 2), "US", ("p", "sdist", "1"), None)])
    assert flatten(src).collect()[0].dt == dt.date(2023, 1, 2)


def test_non_utc_session_refused(spark):
    src = _src(spark, [(_utc(2023, 1, 2, 2), "US", ("p", "sdist", "1"), None)])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(SessionConfigError):
            extract_batch(src, "p", "2023-01-02", "2023-01-02")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_reversed_and_bad_dates(spark, source001):
    with pytest.raises(BadParameter):
        extract_batch(source001, "click", "2024-01-04", "2024-01-01")
    with pytest.raises(BadParameter):
        extract_batch(source001, "click", "2024-1-4", "2024-01-05")
    with pytest.raises(BadParameter):
        parse_date("2024-02-30")


def test_quote_in_project_is_data(spark, source01):
    evil = "a' or '1'='1"
    assert extract_batch(source01, evil, "2024-01-01", "2024-01-30").count() == 0
    assert extract_batch_sql(spark, source01, evil, "2024-01-01", "2024-01-30").count() == 0


def test_sql_form_equals_dataframe_form(spark, source01):
    a = extract_batch(source01, "view", "2024-01-02", "2024-01-05")
    b = extract_batch_sql(spark, source01, "view", "2024-01-02", "2024-01-05")
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_inclusive_whole_days(spark, source01):
    batch = extract_batch(source01, "purchase", "2024-01-04", "2024-01-04")
    times = [r.download_time for r in batch.collect()]
    assert times and all(t.date() == dt.date(2024, 1, 4) for t in times)
    assert dt.datetime(2024, 1, 4, 23, 59, 59, 407119) in times  # the end-of-day row is kept


def test_schema_drift_fails_early(spark):
    bad = spark.createDataFrame([(1,)], "timestamp int")
    with pytest.raises(SchemaDriftError):
        extract_batch(bad, "p", "2024-01-01", "2024-01-01")


def test_instant_bounds_and_default_date():
    lo, hi = instant_bounds("2024-01-01", "2024-01-04")
    assert lo == _utc(2024, 1, 1) and hi == _utc(2024, 1, 4, 23, 59, 59)
    # reversed dates: min / max of (begin 00:00:00, end 23:59:59)
    lo2, hi2 = instant_bounds("2024-01-04", "2024-01-01")
    assert (lo2, hi2) == (_utc(2024, 1, 1, 23, 59, 59), _utc(2024, 1, 4))
    assert instant_bounds("2024-01-01", "2024-01-01", end_exclusive=True)[1] == _utc(2024, 1, 2)
    assert default_query_date(dt.date(2024, 3, 1)) == dt.date(2024, 2, 29)


def test_default_date_column_matches_python(spark):
    from assay.functions.params import default_query_date_col
    got = spark.range(1).select(default_query_date_col().alias("d")).collect()[0].d
    assert got == default_query_date()


def test_extract_utc_day_bounds_on_zone_aware_source(spark):
    src = _src(spark, [
        (_utc(2023, 1, 1, 23, 30), "US", ("p", "sdist", "1.0.0"), None),
        (_utc(2023, 1, 2, 0, 30), "US", ("p", "sdist", "1.0.0"), None),
        (_utc(2023, 1, 2, 23, 59, 59), "US", ("p", "sdist", "1.0.0"), None),
        (_utc(2023, 1, 3, 0, 0), "US", ("p", "sdist", "1.0.0"), None),
    ])
    rows = extract_batch(src, "p", "2023-01-02", "2023-01-02").collect()
    assert [r.dt for r in rows] == [dt.date(2023, 1, 2)] * 2
    assert extract_batch_sql(spark, src, "p", "2023-01-02", "2023-01-02").count() == 2


def test_declared_schema_reads_the_same(spark, scratch):
    import os
    from pyspark.sql import types as T
    from assay import extract_batch
    from assay.sources import downloads_from_events, read_table
    from assay.sources.downloads import downloads_schema, read_downloads
    path = os.path.join(scratch, "src")
    downloads_from_events(read_table(spark, "/root/testdata/sf0.001", "events")).write.parquet(path)
    declared = read_downloads(spark, path, schema=downloads_schema(T.TimestampNTZType()))
    assert declared.columns == ["timestamp", "country_code", "file", "details"]
    spec = ("click", "2024-01-01", "2024-01-10")
    rows = lambda src: sorted(map(tuple, extract_batch(src, *spec).collect()), key=str)
    assert rows(declared) == rows(read_downloads(spark, path))
