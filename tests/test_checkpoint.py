import os

import pytest

from assay import CheckpointFailed, default_suite, extract_batch, run_checkpoint
from assay.functions import rules as R

# FIXTURES.md: expected failed rules per batch (sf0.01 and sf0.001).
BATCHES = [("signup", "2024-01-01", "2024-01-04"), ("view", "2024-01-01", "2024-01-04"),
           ("error", "2024-01-01", "2024-01-04"), ("purchase", "2024-01-01", "2024-01-04"),
           ("click", "2024-01-01", "2024-01-30"), ("nosuch", "2024-01-01", "2024-01-04")]
FAILED_01 = {"signup": 6, "view": 7, "error": 4, "purchase": 6, "click": 5, "nosuch": 4}
FAILED_001 = {"signup": 4, "view": 5, "error": 10, "purchase": 3, "click": 6, "nosuch": 4}
ROWS_01 = {"signup": 259, "view": 274, "error": 250, "purchase": 291, "click": 2006, "nosuch": 0}


def _run(source, spec):
    batch = extract_batch(source, *spec)
    return run_checkpoint(batch, default_suite(batch.columns, spec[1], spec[2]))


@pytest.mark.parametrize("spec", BATCHES, ids=[b[0] for b in BATCHES])
def test_fixture_outcomes_sf001(source01, spec):
    run = _run(source01, spec)
    assert run.stats["evaluated"] == 20
    assert run.stats["failed"] == FAILED_01[spec[0]]
    assert all(r.element_count == ROWS_01[spec[0]] for r in run.rows)


@pytest.mark.parametrize("spec", BATCHES, ids=[b[0] for b in BATCHES])
def test_fixture_outcomes_sf0001(source001, spec):
    assert _run(source001, spec).stats["failed"] == FAILED_001[spec[0]]


def test_signup_detail(source01):
    run = _run(source01, BATCHES[0])
    rows = {(r.rule_type, r.column_name, r.mostly): r for r in run.rows}
    assert rows[(R.NOT_NULL, "country_code", 1.0)].missing_count == 7
    assert rows[(R.NOT_NULL, "python_version", 0.95)].missing_count == 16
    assert rows[(R.NOT_NULL, "installer_name", 0.95)].missing_count == 40
    assert rows[(R.MATCH_REGEX, "pkg_version", 0.95)].unexpected_count == 37
    assert rows[(R.MODE_IN_SET, "distro_name", 1.0)].observed_value == "Debian"
    failed = {(r.rule_type, r.column_name) for r in run.failed_expectations}
    assert failed == {(R.NOT_NULL, "country_code"), (R.NOT_NULL, "python_version"),
                      (R.NOT_NULL, "installer_name"), (R.NOT_NULL, "installer_version"),
                      (R.MATCH_REGEX, "pkg_version"), (R.MODE_IN_SET, "distro_name")}


def test_gate(source01):
    run = _run(source01, BATCHES[2])  # error: 4 failures
    with pytest.raises(CheckpointFailed) as exc:
        run.check_results(failures_allowed=0)
    assert exc.value.failed == 4 and "the limit is 0" in str(exc.value)
    assert {f["column_name"] for f in exc.value.failures} == {"country_code", "installer_name",
                                                            "installer_version", "pkg_version"}
    assert "gate open" in run.check_results(failures_allowed=4)
    assert run.run_name.endswith("_downloads_batch")
    assert len(run.list_failures()) == 4


def test_no_failures_listing(spark):
    from helpers import batch_rows, good_row
    batch = batch_rows(spark, [good_row(i) for i in range(10)])
    run = run_checkpoint(batch, default_suite(batch.columns, "2024-01-02", "2024-01-02"))
    assert run.stats == {"evaluated": 20, "failed": 0, "passed": 20}
    assert run.failed_expectations is None and run.list_failures() == ["every rule passed"]
    assert run.samples(3) is None and run.unexpected_values() is None


def test_samples_of_failed_rules(source01):
    run = _run(source01, BATCHES[1])  # view: country set fails with QQ
    rows = run.samples(2).collect()
    by_rule = {}
    for r in rows:
        by_rule.setdefault(r.column_name, []).append(r)
    assert [(r.value, r.n) for r in by_rule["country_code"] if r.value is not None] == [("QQ", 4)]
    assert all(len(v) <= 2 for v in by_rule.values()) and max(r["rank"] for r in rows) <= 2
    assert run.unexpected_values().count() > len(rows)


def test_history_written(spark, scratch, source01):
    path = os.path.join(scratch, "history")
    batch = extract_batch(source01, "error", "2024-01-01", "2024-01-04")
    run_checkpoint(batch, default_suite(batch.columns, "2024-01-01", "2024-01-04"),
                   data_dt="2024-01-04", history_path=path)
    hist = spark.read.parquet(path)
    assert hist.count() == 20 and {r.data_dt.isoformat() for r in hist.select("data_dt").collect()} == {"2024-01-04"}
    from assay import read_history, run_summaries
    run_checkpoint(batch, default_suite(batch.columns, "2024-01-01", "2024-01-04"),
                   data_dt="2024-01-05", history_path=path)
    assert read_history(spark, path, "2024-01-05", "2024-01-05").count() == 20
    runs = run_summaries(read_history(spark, path)).collect()
    assert len(runs) == 2 and all(r.evaluated == 20 and r.failed == 4 and not r.success for r in runs)


def test_both_publishers_share_one_history(spark, scratch, source01):
    from assay import publish_by_day, publish_if_valid, read_history, run_summaries
    path = os.path.join(scratch, "history")
    batch = extract_batch(source01, "error", "2024-01-01", "2024-01-04")
    suite = default_suite(batch.columns, "2024-01-01", "2024-01-04")
    whole = publish_if_valid(batch, suite, os.path.join(scratch, "t"), failures_allowed=20, history_path=path,
                             data_dt="2024-01-04", project="error")
    daily = publish_by_day(batch, suite, os.path.join(scratch, "t"), "2024-01-01", "2024-01-04", failures_allowed=20,
                           history_path=path, project="error")
    history = read_history(spark, path, project="error")
    assert history.where("run_name IS NULL OR run_dt IS NULL OR project IS NULL").count() == 0
    runs = run_summaries(history).collect()
    assert len([r for r in runs if r.run_id == whole.identity.run_id]) == 1
    assert sorted(r.data_dt.day for r in runs if r.run_id == daily.identity.run_id) == [1, 2, 3, 4]
    assert all(r.evaluated == 20 for r in runs)
