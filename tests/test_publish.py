import glob
import os

import pytest
from pyspark.sql import functions as F

from assay import (CheckpointFailed, default_suite, extract_batch, flatten, publish_by_day, publish_if_valid, publish_projects,
                   publishable_rows, read_published)
from assay.errors import BadParameter
from assay.plans import publish


def _days(spark, path):
    return {r.dt.isoformat(): r.n for r in spark.read.parquet(path).groupBy("dt").agg(F.count("*").alias("n")).collect()}


def test_failed_gate_leaves_target_and_writes_results(spark, scratch, source01):
    target, history = os.path.join(scratch, "target"), os.path.join(scratch, "history")
    good = extract_batch(source01, "error", "2024-01-01", "2024-01-04")
    suite = default_suite(good.columns, "2024-01-01", "2024-01-04")
    report = publish_if_valid(good, suite, target, failures_allowed=20, history_path=history, data_dt="2024-01-04", project="error")
    assert report.rows_staged == 250 and report.run.stats["failed"] == 4
    before = _days(spark, target)
    assert set(before) == {"2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"}
    bad = extract_batch(source01, "view", "2024-01-03", "2024-01-04")  # 7 failed rules
    with pytest.raises(CheckpointFailed):
        publish_if_valid(bad, default_suite(bad.columns, "2024-01-03", "2024-01-04"), target,
                         failures_allowed=0, history_path=history, data_dt="2024-01-04",
                         samples_path=os.path.join(scratch, "samples"), project="view")
    assert _days(spark, target) == before
    assert spark.read.parquet(history).select("run_id").distinct().count() == 2
    assert spark.read.parquet(os.path.join(scratch, "samples")).count() > 0


def test_rerun_replaces_only_that_day(spark, scratch, source01):
    target = os.path.join(scratch, "target")
    batch = extract_batch(source01, "error", "2024-01-01", "2024-01-04")
    suite = default_suite(batch.columns, "2024-01-01", "2024-01-04")
    publish_if_valid(batch, suite, target, failures_allowed=20, project="error")
    before = _days(spark, target)
    day2 = extract_batch(source01, "error", "2024-01-02", "2024-01-02").limit(5)
    publish_if_valid(day2, default_suite(day2.columns, "2024-01-02", "2024-01-02"), target, failures_allowed=20, project="error")
    after = _days(spark, target)
    assert after["2024-01-02"] == 5
    assert {d: n for d, n in after.items() if d != "2024-01-02"} == {d: n for d, n in before.items() if d != "2024-01-02"}


def test_publish_by_day(spark, scratch, source01):
    target = os.path.join(scratch, "target")
    batch = extract_batch(source01, "click", "2024-01-01", "2024-01-30")
    suite = default_suite(batch.columns, "2024-01-01", "2024-01-30")
    with pytest.raises(CheckpointFailed) as exc:
        publish_by_day(batch, suite, target, "2024-01-01", "2024-01-30", failures_allowed=4,
                       history_path=os.path.join(scratch, "history"), samples_path=os.path.join(scratch, "samples"), project="click")
    samples = spark.read.parquet(os.path.join(scratch, "samples"))
    failed_pairs = {(f["dt"], f["rule_id"]) for f in exc.value.failures}
    sampled = {(r.data_dt, r.rule_id) for r in samples.select("data_dt", "rule_id").distinct().collect()}
    assert sampled and sampled <= failed_pairs  # only failed (day, rule) pairs, from row-level rules
    keyed = batch.withColumn("project", F.lit("click"))
    expected = {r.dt.isoformat() for r in publishable_rows(keyed, suite, "2024-01-01", "2024-01-30", 4)
                .select("dt").distinct().collect()}
    assert set(_days(spark, target)) == expected and 0 < len(expected) < 30
    assert spark.read.parquet(os.path.join(scratch, "history")).count() == 30 * 20


def test_empty_batch_stages_and_fails_modes(spark, scratch, source01):
    target = os.path.join(scratch, "target")
    batch = extract_batch(source01, "nosuch", "2024-01-01", "2024-01-04")
    with pytest.raises(CheckpointFailed) as exc:
        publish_if_valid(batch, default_suite(batch.columns, "2024-01-01", "2024-01-04"), target, project="nosuch")
    assert exc.value.failed == 4 and not os.path.exists(target)


def test_published_table_prunes_by_dt(spark, scratch, source01):
    import contextlib
    import io
    import re
    target = os.path.join(scratch, "target")
    batch = extract_batch(source01, "error", "2024-01-01", "2024-01-04")
    publish_if_valid(batch, default_suite(batch.columns, "2024-01-01", "2024-01-04"), target, failures_allowed=20, project="error")
    day = spark.read.parquet(target).where(F.col("dt") == "2024-01-02")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        day.explain("formatted")
    part = re.search(r"PartitionFilters: \[(.*)\]", buf.getvalue()).group(1)
    assert "2024-01-02" in part
    assert day.count() == batch.where(F.col("dt") == "2024-01-02").count()


def test_two_projects_share_a_target(spark, scratch, source01):
    target = os.path.join(scratch, "target")
    counts = {}
    for project in ("click", "view"):
        batch = extract_batch(source01, project, "2024-01-01", "2024-01-04")
        publish_if_valid(batch, default_suite(batch.columns, "2024-01-01", "2024-01-04"), target,
                         failures_allowed=20, project=project)
        counts[project] = batch.count()
    got = spark.read.parquet(target).groupBy("project").count().collect()
    assert {r.project: r["count"] for r in got} == counts
    for folder in glob.glob(f"{target}/*/dt=*"):  # a few files per bucket and day, not one per task
        assert 1 <= len([f for f in os.listdir(folder) if f.endswith(".parquet")]) <= 2


def test_rows_without_a_day_are_seen_and_kept(spark, scratch):
    from assay.sources import downloads_from_events, read_table
    src = downloads_from_events(read_table(spark, "/root/testdata/sf0.01", "events"), null_keys=True)
    from assay import flatten, validate_by_day
    batches = flatten(src, F.col("file.project").alias("project"))
    suite = default_suite([c for c in batches.columns if c != "project"])
    res = validate_by_day(batches, suite, "2024-01-01", "2024-01-30", by=["project"])
    first = res.where("rule_id = 1")
    assert first.agg(F.sum("element_count")).first()[0] == batches.count()
    lost = first.where("dt IS NULL").collect()
    assert len(lost) == 6 and all(r.missing_count == r.element_count > 0 and not r.success for r in lost)
    assert first.where("project IS NULL AND dt IS NOT NULL").count() == 30
    kept = publishable_rows(batches, suite, "2024-01-01", "2024-01-30", failures_allowed=20)
    assert kept.count() == batches.count()


def test_empty_days_and_staging(spark, scratch, source01):
    target = os.path.join(scratch, "target")
    batch = extract_batch(source01, "error", "2024-01-01", "2024-01-04").where("dt != DATE '2024-01-02'")
    suite = default_suite(batch.columns, "2024-01-01", "2024-01-04")
    full = extract_batch(source01, "error", "2024-01-02", "2024-01-02")
    publish_if_valid(full, suite, target, failures_allowed=20, project="error")
    report = publish_by_day(batch, suite, target, "2024-01-01", "2024-01-04", failures_allowed=20, project="error")
    assert [d.day for d in report.empty_days] == [2] and [d.day for d in report.published_days] == [1, 3, 4]
    assert _days(spark, target)["2024-01-02"] == full.count()  # what was published before stays
    assert not os.path.exists(report.staging_path.removeprefix("file:"))


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def many_projects(source, n):
    """Every row goes to one of ``n`` projects, or to none."""
    return flatten(source, F.concat(F.lit("p"), F.pmod(F.xxhash64("timestamp"), F.lit(n))).alias("project")) \
        .withColumn("project", F.when(F.col("project") != "p0", F.col("project")))


def test_folders_do_not_grow_with_projects(spark, scratch, source01):
    suite = default_suite([c for c in many_projects(source01, 2).columns if c != "project"])
    folders = {}
    for n in (200, 400):
        target = os.path.join(scratch, f"t{n}")
        batch = many_projects(source01, n).where("dt <= DATE '2024-01-03'")
        report = publish_projects(batch, suite, target, "2024-01-01", "2024-01-03", failures_allowed=20, staging_root=f"{scratch}/s{n}")
        assert report.batches == report.published == batch.select("project", "dt").distinct().count()
        assert rows_of(read_published(spark, target)) == rows_of(batch)
        folders[n] = len(glob.glob(f"{target}/*/dt=*"))
        assert not os.listdir(f"{scratch}/s{n}/assay-staging")
    assert 100 < folders[200] <= folders[400] <= publish.BUCKETS * 3


def test_other_projects_in_the_bucket_stay(spark, scratch, source01, monkeypatch):
    """Projects share folders; publishing one again leaves the others' rows."""
    target = os.path.join(scratch, "target")
    everything = many_projects(source01, 150).where("dt <= DATE '2024-01-04'")
    suite = default_suite([c for c in everything.columns if c != "project"], "2024-01-01", "2024-01-04")
    publish_projects(everything, suite, target, "2024-01-01", "2024-01-04", failures_allowed=20)
    one = everything.where("project = 'p7' AND dt IN (DATE '2024-01-02', DATE '2024-01-03')").limit(3).drop("project")
    report = publish_if_valid(one, suite, target, failures_allowed=20, project="p7")
    days = [d.isoformat() for d in report.published_days]
    want = everything.where(~F.coalesce((F.col("project") == "p7") & F.col("dt").cast("string").isin(days), F.lit(False)))
    staged = read_published(spark, target, "p7").where(F.col("dt").cast("string").isin(days))
    assert staged.count() == 3
    assert rows_of(read_published(spark, target)) == sorted(rows_of(want) + rows_of(staged))
    # rows without a project, and projects that fail, are handled like any other
    again = everything.where("project IS NULL OR project IN ('p7', 'p8')")
    report = publish_projects(again, suite, target, "2024-01-01", "2024-01-04", failures_allowed=20)
    assert report.failed == 0 and rows_of(read_published(spark, target)) == rows_of(everything)
    report = publish_projects(again, suite, target, "2024-01-01", "2024-01-04", failures_allowed=0)
    assert report.published < report.batches and rows_of(read_published(spark, target)) == rows_of(everything)


def test_publish_projects_publishes_what_passes(spark, scratch, source01):
    target, verdicts = os.path.join(scratch, "target"), os.path.join(scratch, "verdicts")
    batch = flatten(source01, F.col("file.project").alias("project"))
    suite = default_suite([c for c in batch.columns if c != "project"])
    report = publish_projects(batch, suite, target, "2024-01-01", "2024-01-30", failures_allowed=4, verdicts_path=verdicts)
    want = publishable_rows(batch, suite, "2024-01-01", "2024-01-30", failures_allowed=4)
    assert rows_of(read_published(spark, target)) == rows_of(want)
    assert 0 < report.published < report.batches and report.published + report.failed == report.batches
    assert spark.read.parquet(verdicts).where("failed <= 4").count() == report.published


def test_one_project_is_read_from_one_bucket(spark, scratch, source01):
    import contextlib
    import io
    target = os.path.join(scratch, "target")
    batch = many_projects(source01, 60).where("dt <= DATE '2024-01-02'")
    suite = default_suite([c for c in batch.columns if c != "project"])
    publish_projects(batch, suite, target, "2024-01-01", "2024-01-02", failures_allowed=20)
    one = read_published(spark, target, "p5", "2024-01-01", "2024-01-01")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        one.explain("formatted")
    assert "EqualTo(project,p5)" in buf.getvalue() and f"({publish.BUCKET}" in buf.getvalue().split("PartitionFilters")[1]
    assert rows_of(one) == rows_of(batch.where("project = 'p5' AND dt = DATE '2024-01-01'"))


def test_a_publish_that_broke_off_is_finished(spark, scratch, source01, monkeypatch):
    target = os.path.join(scratch, "target")
    batch = many_projects(source01, 90).where("dt <= DATE '2024-01-02'")
    suite = default_suite([c for c in batch.columns if c != "project"])
    publish_projects(batch, suite, target, "2024-01-01", "2024-01-02", failures_allowed=20)
    merged = []
    with monkeypatch.context() as m:
        m.setattr(publish, "finish_publish", lambda spark, path, target, schema: merged.append((path, schema)) or (_ for _ in ()).throw(OSError()))
        with pytest.raises(OSError):
            publish_projects(batch.limit(40), suite, target, "2024-01-01", "2024-01-02", failures_allowed=20)
    assert rows_of(read_published(spark, target)) == rows_of(batch)     # untouched so far
    path, schema = merged[0]
    with monkeypatch.context() as m:
        m.setattr(publish, "drop_staging", lambda *a: None)
        publish.finish_publish(spark, path, target, schema)
    once = rows_of(read_published(spark, target))
    publish.finish_publish(spark, path, target, schema)
    assert rows_of(read_published(spark, target)) == once != rows_of(batch)


def test_another_layout_is_refused(spark, scratch, source01):
    target = os.path.join(scratch, "target")
    batch = extract_batch(source01, "error", "2024-01-01", "2024-01-02")
    batch.withColumn("project", F.lit("error")).write.partitionBy("project", "dt").parquet(target)
    with pytest.raises(BadParameter):
        publish_if_valid(batch, default_suite(batch.columns, "2024-01-01", "2024-01-02"), target, failures_allowed=20, project="error")


def test_a_target_that_nothing_passed_into_has_no_rows(spark, scratch):
    """Every batch fails: the new target has no files, so none that a schema could be taken from."""
    import __spark_entry__ as entry
    day = "TIMESTAMP_NTZ '2024-01-01 00:00:00'"
    events = spark.range(1, 401).selectExpr("id * 50 AS event_id", f"{day} + make_dt_interval(CAST(id % 3 AS INT)) AS ts", "'view' AS event_type")
    events.write.parquet(os.path.join(scratch, "events.parquet"))     # no details in any row: 12 rules fail
    found = entry.queries()["publish_if_valid"](spark, scratch)
    same = entry.queries()["publishable_rows"](spark, scratch)
    assert found.count() == same.count() == 0
    assert found.dtypes == same.dtypes
