"""Value tables, the one-scan form and day filling against simpler ways to the same results."""

import random

import pytest
from pyspark.sql import functions as F

from assay import Suite, default_suite, validate
from assay.errors import BadParameter
from assay.functions import rules as R
from assay.operators.metrics import fill_days
from assay.operators.samples import unexpected_values
from assay.plans.by_day import validate_by_day


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def batch_of(spark, seed, n=400):
    rnd = random.Random(seed)
    pick = lambda *v: rnd.choice(v)
    rows = [(pick("a", "b", None), pick(1, 2, 3, 7, None), pick(0.0, -0.0, 1.0, 2.5, None), pick("x", "y", "zz", None),
             pick(True, False, None)) for _ in range(n)]
    return spark.createDataFrame(rows, "g string, i int, d double, s string, b boolean").repartition(3)


def rules(spark):
    table = lambda values, t: spark.createDataFrame([(v,) for v in values], f"`the value` {t}, other int"[:-len(", other int")])
    return {
        "i": ([1.0, 2.0, 2.0, None], "double"), "d": ([0, 1], "int"), "s": (["x", None, "q"], "string"), "b": ([True], "boolean"),
    }, table


@pytest.mark.parametrize("one_scan", [False, True])
@pytest.mark.parametrize("keys", [[], ["g"]])
def test_value_tables_equal_literal_lists(spark, one_scan, keys):
    """A set as a table gives what the same set as a list gives, typed alike."""
    sets, table = rules(spark)
    batch = batch_of(spark, 1)
    as_table = [R.Rule(R.IN_SET, c, 0.5, {"value_set": table(*v)}) for c, v in sets.items()]
    as_list = [R.Rule(R.IN_SET, c, 0.5, {"value_set": [x for x in v if x is not None]}) for c, (v, _) in sets.items()]
    got = validate(batch, Suite("t", as_table), group_cols=keys, one_scan=one_scan)
    assert rows_of(got) == rows_of(validate(batch, Suite("t", as_list), group_cols=keys))
    assert {r.unexpected_count > 0 for r in got.where("rule_id <> 4").collect()} == {True}
    empty = validate(batch.where("false"), Suite("t", as_table), group_cols=[], one_scan=one_scan).collect()
    assert len(empty) == 4 and all(r.success and r.element_count == 0 and r.unexpected_count == 0 for r in empty)


def test_unexpected_values_of_tables(spark):
    sets, table = rules(spark)
    batch = batch_of(spark, 2)
    as_table = [(n, R.Rule(R.IN_SET, c, 1.0, {"value_set": table(*v)})) for n, (c, v) in enumerate(sets.items(), 1)]
    got = unexpected_values(batch, as_table, {}, ["g"])
    want = None
    for n, c, ok in ((1, "i", "i IN (1, 2)"), (2, "d", "d IN (0, 1)"), (3, "s", "s IN ('x', 'q')"), (4, "b", "b")):
        part = batch.where(f"{c} IS NOT NULL AND NOT ({ok})").groupBy("g", F.lit(n).alias("rule_id"), F.lit(c).alias("column_name"),
                                                                  F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n"))
        want = part if want is None else want.union(part)
    assert rows_of(got) == rows_of(want)


def test_table_of_another_type_is_refused(spark):
    dim = spark.createDataFrame([([1],)], "v array<int>")
    with pytest.raises(BadParameter):
        validate(batch_of(spark, 3, 5), Suite("t", [R.Rule(R.IN_SET, "i", 1.0, {"value_set": dim})]))


@pytest.mark.parametrize("seed", range(3))
def test_one_scan_equals_two(spark, seed):
    batch = batch_of(spark, 10 + seed)
    suite = Suite("m", [
        R.Rule(R.NOT_NULL, "i", 0.5), R.Rule(R.BETWEEN, "d", 0.5, {"min_value": 0.5}), R.Rule(R.MATCH_REGEX, "s", 0.5, {"regex": "^x"}),
        R.Rule(R.MODE_IN_SET, "s", kwargs={"value_set": ["x", "y"]}), R.Rule(R.MODE_IN_SET, "i", kwargs={"value_set": [3]}),
        R.Rule(R.MODE_IN_SET, "d", kwargs={"value_set": [0.0]}), R.Rule(R.OF_TYPE, "b", kwargs={"type_": "boolean"}),
        R.Rule(R.IN_SET, "i", 0.5, {"value_set": spark.createDataFrame([(7,), (1,)], "v long")})])
    for keys in ([], ["g"], ["g", "s"]):    # a key that is a rule's column too
        once, twice = (validate(batch, suite, group_cols=keys, one_scan=x) for x in (True, False))
        assert rows_of(once) == rows_of(twice)
        once, twice = (validate(batch.where("false"), suite, group_cols=keys, one_scan=x) for x in (True, False))
        assert rows_of(once) == rows_of(twice)


def test_days_are_filled(spark):
    days = 3000
    sql = f"sequence(DATE '2010-01-01', date_add(DATE '2010-01-01', {days - 1}))"
    metrics = spark.sql("SELECT * FROM VALUES ('a', DATE '2010-01-02', 5, 1), ('a', NULL, 2, 0), ('b', DATE '2018-03-19', 7, NULL), "
                        "(NULL, DATE '2010-01-01', 1, 1) AS t(project, dt, m_n, m_null)")
    got = fill_days(metrics, ["project"], "dt", F.expr(sql))
    assert got.groupBy("project").count().collect() and got.count() == 3 * days + 1
    assert {(r.project, str(r.dt), r.m_n, r.m_null) for r in got.where("m_n IS NOT NULL").collect()} == {
        ("a", "2010-01-02", 5, 1), ("a", "None", 2, 0), ("b", "2018-03-19", 7, None), (None, "2010-01-01", 1, 1)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan.lower().replace("arrayfilter", "filter(") and "Join" not in plan


def test_by_day_over_many_days(spark, source01):
    from assay import flatten
    batch = flatten(source01, F.col("file.project").alias("project"))
    suite = default_suite([c for c in batch.columns if c != "project"])
    got = validate_by_day(batch, suite, "2023-01-01", "2024-12-31", by=["project"])
    assert got.where("rule_id = 1").count() == 731 * 5
    want = validate_by_day(batch, suite, "2024-01-01", "2024-01-30", by=["project"])
    assert rows_of(got.where("dt BETWEEN '2024-01-01' AND '2024-01-30'")) == rows_of(want)
