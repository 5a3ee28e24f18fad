"""Plan checks on a real nested Parquet source (pruning needs a file scan)."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from assay import Suite, default_suite, extract_batch, validate
from assay.functions import rules as R
from assay.sources import downloads_from_events, read_downloads, read_table


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def nested_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("nested") / "downloads")
    downloads_from_events(read_table(spark, "/root/testdata/sf0.01", "events")).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def nested_by_dt(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("nested_dt") / "downloads")
    src = downloads_from_events(read_table(spark, "/root/testdata/sf0.01", "events"))
    src.withColumn("dt", F.to_date("timestamp")).write.partitionBy("dt").parquet(path)
    return path


def test_extract_pushes_filters(spark, nested_path):
    batch = extract_batch(read_downloads(spark, nested_path), "click", "2024-01-01", "2024-01-04")
    text = plan_text(batch)
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "EqualTo(file.project,click)" in pushed
    assert "GreaterThanOrEqual(timestamp,2024-01-01T00:00)" in pushed
    assert "LessThan(timestamp,2024-01-05T00:00)" in pushed


def test_nested_pruning_in_read_schema(spark, nested_path):
    batch = extract_batch(read_downloads(spark, nested_path), "click", "2024-01-01", "2024-01-04")
    suite = default_suite(batch.columns)
    modes_only = Suite("m", [r for r in suite.rules if r.kind == R.MODE_IN_SET])
    text = plan_text(validate(batch, modes_only))
    schemas = re.findall(r"ReadSchema: (struct<.*>)", text)
    assert schemas
    for s in schemas:
        assert "country_code" not in s and "python" not in s and "release" not in s
        assert "installer:struct<name:string>" in s and "distro:struct<name:string>" in s


def test_fused_suite_is_one_scan_one_exchange(spark, nested_path):
    batch = extract_batch(read_downloads(spark, nested_path), "click", "2024-01-01", "2024-01-30")
    suite = default_suite(batch.columns, "2024-01-01", "2024-01-30")
    row_rules = Suite("rows", [r for r in suite.rules if r.kind != R.MODE_IN_SET], suite.params)
    text = plan_text(validate(batch, row_rules))
    initial = text.split("== Initial Plan ==")[-1] if "== Initial Plan ==" in text else text
    tree = initial.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1
    assert tree.count("Exchange") == 1
    assert "SinglePartition" in text


def test_whole_suite_is_one_scan_no_nested_loop(spark, nested_path):
    batch = extract_batch(read_downloads(spark, nested_path), "click", "2024-01-01", "2024-01-30")
    df = validate(batch, default_suite(batch.columns, "2024-01-01", "2024-01-30"))
    df.collect()
    text = plan_text(df)
    final = text.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    assert final.count("Scan parquet") == 1  # counters and value counts from one pre-aggregate
    assert "Window" not in final  # modes are decided by counts, nothing is ranked
    assert "NestedLoopJoin" not in final and "CartesianProduct" not in final


def test_dt_partition_pruning(spark, nested_by_dt):
    src = read_downloads(spark, nested_by_dt)
    batch = extract_batch(src, "view", "2024-01-02", "2024-01-03")
    text = plan_text(batch)
    part = re.search(r"PartitionFilters: \[(.*)\]", text).group(1)
    assert "dt" in part and "2024-01-02" in part
    assert batch.count() == extract_batch(
        downloads_from_events(read_table(spark, "/root/testdata/sf0.01", "events")),
        "view", "2024-01-02", "2024-01-03").count()


def test_in_set_dimension_is_joined_to_value_counts(spark, nested_path):
    from assay.sources.countries import country_dim
    batch = extract_batch(read_downloads(spark, nested_path), "view", "2024-01-01", "2024-01-04")
    rule = R.Rule(R.IN_SET, "country_code", 0.99, {"value_set": country_dim(spark)})
    text = plan_text(validate(batch, Suite("d", [rule])))
    tree = text.split("\n\n")[0]
    assert "LeftOuter" in text and tree.index("Join") < tree.index("HashAggregate", tree.index("Join"))  # counts below the join
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_sql_form_pushes_the_same_filters(spark, nested_path):
    from assay import extract_batch_sql
    text = plan_text(extract_batch_sql(spark, read_downloads(spark, nested_path), "click", "2024-01-01", "2024-01-04"))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "EqualTo(file.project,click)" in pushed
    assert "GreaterThanOrEqual(timestamp,2024-01-01T00:00)" in pushed and "LessThan(timestamp,2024-01-05T00:00)" in pushed


def test_sql_form_prunes_dt_partitions(spark, nested_by_dt):
    from assay import extract_batch_sql
    src = read_downloads(spark, nested_by_dt)
    batch = extract_batch_sql(spark, src, "view", "2024-01-02", "2024-01-03")
    part = re.search(r"PartitionFilters: \[(.*)\]", plan_text(batch)).group(1)
    assert "dt" in part and "2024-01-02" in part
    assert batch.count() == extract_batch(src, "view", "2024-01-02", "2024-01-03").count()


def final_plan(df) -> str:
    df.collect()
    return plan_text(df).split("== Final Plan ==")[1].split("== Initial Plan ==")[0]


def test_value_tables_share_a_scan(spark, nested_path):
    """Rules with a value table, and mode rules beside them, add no scan of the batch."""
    from assay.sources.countries import country_dim
    batch = extract_batch(read_downloads(spark, nested_path), "view", "2024-01-01", "2024-01-30")
    names = spark.createDataFrame([("pip",), ("conda",), (None,)], "name string")
    tables = [R.Rule(R.IN_SET, "country_code", 0.99, {"value_set": country_dim(spark)}),
              R.Rule(R.IN_SET, "installer_name", 0.9, {"value_set": names}),
              R.Rule(R.IN_SET, "pkg_version", 0.0, {"value_set": names})]
    modes = [r for r in default_suite(batch.columns).rules if r.kind == R.MODE_IN_SET]
    for rules in (tables[:1], tables, tables + modes):
        assert final_plan(validate(batch, Suite("t", rules))).count("Scan parquet") == 2
        assert final_plan(validate(batch, Suite("t", rules), one_scan=True)).count("Scan parquet") == 1


def test_one_scan_form(spark, nested_path):
    batch = extract_batch(read_downloads(spark, nested_path), "click", "2024-01-01", "2024-01-30")
    suite = default_suite(batch.columns, "2024-01-01", "2024-01-30")
    once, twice = (validate(batch, suite, one_scan=x) for x in (True, False))
    text = final_plan(once)
    assert text.count("Scan parquet") == 1 and "Window" not in text and "Join" not in text
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_publishable_rows_prune_at_run_time(spark, nested_path):
    """Verdicts are joined, not collected: the reader of the staged rows gets its partitions from them while it runs."""
    from assay import flatten, publishable_rows
    from assay.operators.extract import BATCH_COLUMNS
    batches = flatten(read_downloads(spark, nested_path), F.col("file.project").alias("project"))
    good = publishable_rows(batches, default_suite(list(BATCH_COLUMNS)), "2024-01-01", "2024-01-30", 4)
    text = final_plan(good)
    whole = plan_text(good)
    assert "dynamicpruning" in whole
    pruned = [p for p in re.findall(r"PartitionFilters: \[(.*)\]", whole) if "dynamicpruning" in p]
    assert pruned and all("bucket_64" in p and "staged_day" in p and " OR " not in p for p in pruned)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert 0 < good.count() < batches.count()
