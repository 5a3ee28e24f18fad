"""Per-day validation of a long batch (backfill) in one pass.

The daily run validates one ``dt`` at a time.  A backfill of many days does the
same with the fused metrics grouped by ``dt`` and the modes grouped by
(``dt``, column): still two scans in total, whatever the number of days.  The
time-range rule is bound to each row's own day, so the result for a day equals
the daily run of that day.  A day of the range without rows is reported too (as
an empty batch: its mode rules fail), and rows without a day form a group of
their own (``dt`` NULL).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import params as P
from .checkpoint import run_stats, validate
from .suite import Suite


def _date(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("date")


def validate_by_day(batch: DataFrame, suite: Suite, begin: str | dt.date, end: str | dt.date,
                    params: Mapping | None = None, end_exclusive: bool = False,
                    by: Sequence[str] = ()) -> DataFrame:
    """Results per (``by`` keys, dt, rule) for every day of ``begin..end``, and for rows of no day.

    ``by`` adds batch keys (e.g. ``project``): every (key, day) is its own daily
    batch, for each key seen in those rows.
    """
    b, e = P.date_range(begin, end)
    rows = batch.where(F.col("dt").between(_date(b), _date(e)) | F.col("dt").isNull())
    run_params = P.merge_params(params, P.day_params("dt", end_exclusive))
    return validate(rows, suite, run_params, group_cols=[*by, "dt"], days=("dt", F.sequence(_date(b), _date(e))))


def stats_by_day(results_by_day: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return run_stats(results_by_day, [*by, "dt"])
