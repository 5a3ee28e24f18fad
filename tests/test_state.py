"""Incremental validation: merged state equals a full run, and only new days are read."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from assay import Suite, default_suite, flatten, validate
from assay.functions import params as P
from assay.functions import rules as R
from assay.plans.by_day import validate_by_day
from assay.plans.state import held_days, results_from_state, state_key, update_state


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def batches(spark, source01):
    return flatten(source01, F.col("file.project").alias("project"))


def suite_for(batches):
    return default_suite([c for c in batches.columns if c != "project"])


def full_run(batches, suite, begin, end, by=("project",)):
    days = batches.where(F.col("dt").between(F.lit(begin).cast("date"), F.lit(end).cast("date")))
    return validate(days, suite, P.day_params("dt"), group_cols=list(by))


def test_merged_state_equals_a_full_run(spark, scratch, batches):
    suite, path = suite_for(batches), f"{scratch}/state"
    assert len(update_state(batches, suite, path, "2024-01-01", "2024-01-10")) == 10
    assert [d.day for d in update_state(batches, suite, path, "2024-01-05", "2024-01-20")] == list(range(11, 21))
    assert update_state(batches, suite, path, "2024-01-03", "2024-01-20") == []
    for begin, end in (("2024-01-01", "2024-01-20"), ("2024-01-04", "2024-01-15"), ("2024-01-07", "2024-01-07")):
        got = results_from_state(spark, path, suite, batches.schema, begin, end)
        assert rows_of(got) == rows_of(full_run(batches, suite, begin, end))
    per_day = results_from_state(spark, path, suite, batches.schema, "2024-01-02", "2024-01-19", per_day=True)
    assert rows_of(per_day) == rows_of(validate_by_day(batches, suite, "2024-01-02", "2024-01-19", by=["project"]).where("dt IS NOT NULL"))


@pytest.mark.parametrize("seed", range(2))
def test_any_order_of_updates(spark, scratch, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["p", "q", None]), dt.date(2024, 1, rnd.randint(1, 8)), rnd.choice([0.0, -0.0, 1.5, None]), rnd.choice(["x", "y", None]))
            for _ in range(300)]
    batch = spark.createDataFrame(rows, "project string, dt date, d double, s string")
    suite = Suite("any", [
        R.Rule(R.NOT_NULL, "d", 0.5), R.Rule(R.BETWEEN, "d", 0.5, {"min_value": 1}), R.Rule(R.MODE_IN_SET, "s", kwargs={"value_set": ["x"]}),
        R.Rule(R.MODE_IN_SET, "d", kwargs={"value_set": [0.0]}), R.Rule(R.OF_TYPE, "s", kwargs={"type_": "string"}),
        R.Rule(R.IN_SET, "s", 0.5, {"value_set": ["y"]})])
    path = f"{scratch}/state"
    for begin, end in rnd.sample([(1, 3), (5, 8), (2, 6)], 3):
        update_state(batch, suite, path, dt.date(2024, 1, begin), dt.date(2024, 1, end))
    for by in (("project",),):
        got = results_from_state(spark, path, suite, batch.schema, "2024-01-01", "2024-01-08", by)
        assert rows_of(got) == rows_of(full_run(batch, suite, "2024-01-01", "2024-01-08", by))


def test_no_keys_and_empty_days(spark, scratch, batches):
    suite, path = suite_for(batches), f"{scratch}/state"
    update_state(batches, suite, path, "2023-12-30", "2024-01-03", by=())
    got = results_from_state(spark, path, suite, batches.schema, "2023-12-30", "2024-01-03", by=())
    assert rows_of(got) == rows_of(full_run(batches, suite, "2023-12-30", "2024-01-03", ()))
    empty = results_from_state(spark, path, suite, batches.schema, "2023-12-30", "2023-12-31", by=()).collect()
    assert len(empty) == 20 and sum(not r.success for r in empty) == 4      # the four mode rules, as of an empty batch
    with pytest.raises(P.BadParameter):
        results_from_state(spark, f"{scratch}/none", suite, batches.schema, "2024-01-01", "2024-01-02")


def test_late_rows_and_other_rules(spark, scratch, batches):
    suite, path = suite_for(batches), f"{scratch}/state"
    first = batches.where("pkg_version NOT LIKE '1%'")
    update_state(first, suite, path, "2024-01-01", "2024-01-04")
    day = dt.date(2024, 1, 2)
    assert update_state(batches, suite, path, "2024-01-01", "2024-01-04", again=[day]) == [day]
    mixed = first.where(F.col("dt") != F.lit(day)).union(batches.where(F.col("dt") == F.lit(day)))
    got = results_from_state(spark, path, suite, batches.schema, "2024-01-01", "2024-01-04")
    assert rows_of(got) == rows_of(full_run(mixed, suite, "2024-01-01", "2024-01-04"))
    fewer = Suite(suite.name, suite.rules[:5], suite.params)
    assert state_key(fewer, batches.schema, ["project"]) != state_key(suite, batches.schema, ["project"])
    moved = Suite(suite.name, suite.rules, P.timestamp_params("2020-01-01", "2020-01-02"))     # bounds come from the days
    assert state_key(moved, batches.schema, ["project"]) == state_key(suite, batches.schema, ["project"])


def test_an_update_that_broke_off_is_done_again(spark, scratch, batches):
    suite, path = suite_for(batches), f"{scratch}/state"
    update_state(batches, suite, path, "2024-01-01", "2024-01-02")
    key = state_key(suite, batches.schema, ["project"])
    values = spark.read.parquet(f"{path}/values/suite={key}")
    values.where("dt = DATE '2024-01-02'").limit(1).withColumn("dt", F.lit(dt.date(2024, 1, 3))) \
        .write.mode("append").partitionBy("dt").parquet(f"{path}/values/suite={key}")      # values written, counters not
    assert [d.day for d in held_days(spark, path, key, dt.date(2024, 1, 1), dt.date(2024, 1, 31))] == [1, 2]
    assert [d.day for d in update_state(batches, suite, path, "2024-01-01", "2024-01-03")] == [3]
    got = results_from_state(spark, path, suite, batches.schema, "2024-01-01", "2024-01-03")
    assert rows_of(got) == rows_of(full_run(batches, suite, "2024-01-01", "2024-01-03"))


def test_only_new_days_are_read(spark, scratch, batches):
    """Days that the state holds are not opened any more: their files can be unreadable."""
    source, path = f"{scratch}/source", f"{scratch}/state"
    batches.write.partitionBy("dt").parquet(source)
    stored = spark.read.schema(batches.schema).parquet(source)
    suite = suite_for(batches)
    want = rows_of(full_run(stored, suite, "2024-01-01", "2024-01-30"))
    update_state(stored, suite, path, "2024-01-01", "2024-01-28")
    for file in glob.glob(f"{source}/dt=2024-01-0*/part-*"):
        with open(file, "wb") as f:
            f.write(b"not a Parquet file")
        os.utime(file)
    for crc in glob.glob(f"{source}/dt=2024-01-0*/.part-*.crc"):
        with open(crc, "wb") as f:
            f.write(b"")
    assert [d.day for d in update_state(stored, suite, path, "2024-01-01", "2024-01-30")] == [29, 30]
    assert rows_of(results_from_state(spark, path, suite, stored.schema, "2024-01-01", "2024-01-30")) == want
    with pytest.raises(Exception, match="dt=2024-01-0"):
        update_state(stored, suite, path, "2024-01-01", "2024-01-30", again=[dt.date(2024, 1, 3)])
