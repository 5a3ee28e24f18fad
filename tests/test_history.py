"""History: many appends, compaction, and compactions that break off."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from assay import default_suite, flatten, read_history, run_summaries
from assay.plans import history
from assay.plans.by_day import validate_by_day
from assay.plans.history import append_results, compact_history


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture()
def filled(spark, scratch, source01):
    """Eight daily runs, each of two projects' last three days."""
    path = f"{scratch}/history"
    batch = flatten(source01, F.col("file.project").alias("project")).where("project IN ('view', 'click')")
    suite = default_suite([c for c in batch.columns if c != "project"])
    for n in range(8):
        day = dt.date(2024, 1, 3 + n)
        append_results(validate_by_day(batch, suite, day - dt.timedelta(days=2), day, by=["project"]), suite.name, path)
    return path


def files(path, day="*"):
    return len(glob.glob(f"{path}/data_dt={day}/*.parquet"))


def test_compaction_keeps_the_rows(spark, filled):
    before, crowded = rows_of(read_history(spark, filled)), files(filled)
    summaries = rows_of(run_summaries(read_history(spark, filled)))
    report = compact_history(spark, filled)
    assert files(filled) == 10 < report.files_before <= crowded and report.days == 8 and not report.resumed
    assert rows_of(read_history(spark, filled)) == before and len(before) == 8 * 3 * 2 * 20
    assert rows_of(run_summaries(read_history(spark, filled))) == summaries
    assert compact_history(spark, filled).days == 0 and files(filled) == 10


def test_days_without_a_date_and_few_files(spark, scratch, source01):
    path = f"{scratch}/history"
    batch = flatten(source01, F.lit("p").alias("project")).withColumn("dt", F.lit(None).cast("date"))
    suite = default_suite([c for c in batch.columns if c != "project"])
    for _ in range(3):
        append_results(validate_by_day(batch, suite, "2024-01-01", "2024-01-01", by=["project"]), suite.name, path)
    before = rows_of(read_history(spark, path))
    assert compact_history(spark, path, max_files=5).days == 0
    assert compact_history(spark, path).days == 2 and files(path) == 2
    assert rows_of(read_history(spark, path)) == before


def test_broken_off_before_the_days_are_replaced(spark, filled, monkeypatch):
    before = rows_of(read_history(spark, filled))
    with monkeypatch.context() as m:
        m.setattr(history, "_put", lambda *a: (_ for _ in ()).throw(OSError()))
        with pytest.raises(OSError):
            compact_history(spark, filled)
    assert rows_of(read_history(spark, filled)) == before
    assert compact_history(spark, filled).resumed and rows_of(read_history(spark, filled)) == before


def test_broken_off_while_days_are_replaced(spark, filled, source01, monkeypatch):
    """A day is gone from the history, only the folder beside it has it; another run has been appended since."""
    before = read_history(spark, filled)
    lost = [r for r in rows_of(before)]
    with monkeypatch.context() as m:
        m.setattr(history, "_put", lambda *a: (_ for _ in ()).throw(OSError()))
        with pytest.raises(OSError):
            compact_history(spark, filled)
    before.where("data_dt = DATE '2024-01-05'").limit(0).coalesce(1)
    empty = spark.createDataFrame([], history.HISTORY_SCHEMA).drop("data_dt")
    empty.write.mode("overwrite").parquet(f"{filled}/data_dt=2024-01-05")
    assert len(rows_of(read_history(spark, filled))) < len(lost)
    batch = flatten(source01, F.lit("late").alias("project"))
    suite = default_suite([c for c in batch.columns if c != "project"])
    append_results(validate_by_day(batch, suite, "2024-01-05", "2024-01-05", by=["project"]), suite.name, filled)
    late = rows_of(read_history(spark, filled, project="late"))
    report = compact_history(spark, filled)
    assert report.resumed and rows_of(read_history(spark, filled)) == sorted(lost + late)
    assert not glob.glob(f"{filled}-compacting*")
