"""Property tests (seeded): invariants of the rule metrics."""

import random

import pytest
from pyspark.sql import functions as F

from assay import Rule, Suite, default_suite, extract_batch, validate, validate_by_day
from assay.functions import rules as R
from assay.plans.suite import VERSION_REGEX

RESULT_KEY = ("rule_id", "element_count", "missing_count", "unexpected_count", "observed_value", "success")


def _key(rows):
    return sorted(tuple(getattr(r, k) for k in RESULT_KEY) for r in rows)


@pytest.fixture(scope="module")
def click(source01):
    return extract_batch(source01, "click", "2024-01-01", "2024-01-30")


@pytest.fixture(scope="module")
def suite(click):
    return default_suite(click.columns, "2024-01-01", "2024-01-30")


def test_same_under_repartition_and_shuffle(click, suite):
    base = _key(validate(click, suite).collect())
    for n in (1, 3, 8):
        assert _key(validate(click.repartition(n), suite).collect()) == base
    assert _key(validate(click.orderBy(F.rand(7)), suite).collect()) == base


def test_fused_equals_one_rule_at_a_time(click, suite):
    fused = {r.rule_id: r for r in validate(click, suite).collect()}
    for rid, rule in suite.numbered():
        alone = validate(click, Suite("one", [rule], dict(suite.params))).collect()[0]
        f = fused[rid]
        assert (alone.element_count, alone.missing_count, alone.unexpected_count, alone.observed_value, alone.success) \
            == (f.element_count, f.missing_count, f.unexpected_count, f.observed_value, f.success)


def test_days_add_up_to_whole(click, suite):
    whole = {r.rule_id: r for r in validate(click, suite).collect()}
    days = validate_by_day(click, suite, "2024-01-01", "2024-01-30").collect()
    assert len(days) == 30 * 20
    for rid, rule in suite.numbered():
        part = [r for r in days if r.rule_id == rid]
        assert sum(r.element_count for r in part) == whole[rid].element_count
        assert sum(r.missing_count or 0 for r in part) == (whole[rid].missing_count or 0)
        if rule.kind in (R.IN_SET, R.MATCH_REGEX, R.NOT_NULL):
            assert sum(r.unexpected_count for r in part) == whole[rid].unexpected_count


def test_day_without_rows_is_reported(click, suite):
    days = validate_by_day(click.where(F.col("dt") != "2024-01-05"), suite, "2024-01-01", "2024-01-30").collect()
    day5 = [r for r in days if r.dt.isoformat() == "2024-01-05"]
    assert len(day5) == 20 and all(r.element_count == 0 for r in day5)
    assert {r.rule_type for r in day5 if not r.success} == {R.MODE_IN_SET}


@pytest.mark.parametrize("seed", [1, 2, 3, 4, 5])
def test_counts_partition_and_set_growth(spark, seed):
    rnd = random.Random(seed)
    pool = ["US", "DE", "FR", "QQ", "us", None]
    values = [rnd.choice(pool) for _ in range(rnd.randint(0, 200))]
    df = spark.createDataFrame([(v,) for v in values], "c string")
    n = len(values)
    nulls = sum(v is None for v in values)
    prev = None
    for allowed in (["US"], ["US", "DE"], ["US", "DE", "FR", "QQ"]):
        r = validate(df, Suite("p", [Rule(R.IN_SET, "c", 0.5, {"value_set": allowed})])).collect()[0]
        expected = sum(v is not None and v in allowed for v in values)
        assert r.unexpected_count + expected + r.missing_count == n and r.missing_count == nulls
        if prev is not None:
            assert r.unexpected_count <= prev  # adding allowed values never adds unexpected ones
        prev = r.unexpected_count


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_regex_and_mode_against_python(spark, seed):
    import re
    from collections import Counter
    rnd = random.Random(seed)
    pool = ["1.2.3", "0.16.13", "1.2.345", "10.1.1", "x", None]
    values = [rnd.choice(pool) for _ in range(rnd.randint(1, 300))]
    df = spark.createDataFrame([(v,) for v in values], "c string")
    suite = Suite("p", [Rule(R.MATCH_REGEX, "c", 0.5, {"regex": VERSION_REGEX}),
                        Rule(R.MODE_IN_SET, "c", kwargs={"value_set": ["1.2.3"]})])
    regex_r, mode_r = sorted(validate(df, suite).collect(), key=lambda r: r.rule_id)
    nonnull = [v for v in values if v is not None]
    bad = sum(not re.search(VERSION_REGEX, v) for v in nonnull)
    assert regex_r.unexpected_count == bad
    counts = Counter(nonnull)
    top = max(counts.values()) if counts else 0
    modes = sorted(v for v, c in counts.items() if c == top)
    assert mode_r.success is (modes == ["1.2.3"])
    assert (mode_r.observed_value or "") == ",".join(modes[:20])
