"""Incremental validation: mergeable metrics per (keys, day), kept as tables.

A long backfill that is validated again every day reads all days again.  What the rules need of a day is small and adds up:
counters (rows, nulls, unexpected rows) and value counts.  ``update_state`` computes them for days that the state does not hold
yet, in the usual two scans of those days only, and ``results_from_state`` merges any range of days into the
results of a full run, per day or over all days: sums of counters and of value counts are exact, and modes, ties and sets
are decided on the merged counts.

The state is two Parquet tables, ``counters`` and ``values``, partitioned by suite and day.  ``suite`` is a hash of the rules and
the parameters, so a changed rule starts a state of its own.  A day is replaced as a whole (dynamic partition overwrite), values
first, counters last; a day counts as held when its counters are there, so an update that broke off is done again.

Time bounds are those of each row's own day, as in ``by_day``.  Rows without a day are not part of the state.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import params as P
from ..functions import rules as R
from ..operators.metrics import RESULT_COLUMNS, metric_sql, results_of, split_rules, with_entries
from ..operators.modes import entries_of, value_counts
from .suite import Suite

DAY = "dt"
VALUE_FIELDS = "rule_id int, value string, in_set boolean, n long"


def state_key(suite: Suite, schema: T.StructType, by: Sequence[str], end_exclusive: bool = False) -> str:
    """Names a state: rules, their columns' types, parameters that are not bound to the day, and keys."""
    rules = [(i, r.kind, r.column, r.mostly, r.kwargs_json(), R.column_type(schema, r.column).simpleString()) for i, r in suite.numbered()]
    fixed = {k: P.to_json_value(v) for k, v in sorted(suite.params.items()) if k not in P.day_params(DAY)}
    return hashlib.sha256(json.dumps([rules, fixed, list(by), bool(end_exclusive)], sort_keys=True, default=str).encode()).hexdigest()[:24]


def _parts(batch: DataFrame, suite: Suite, by: Sequence[str], params: Mapping) -> tuple[DataFrame, DataFrame | None]:
    keys = [*by, DAY]
    counted, value_rules = split_rules(suite.numbered(), batch.schema)
    exprs, _ = metric_sql(counted, batch.schema, params)
    counters = batch.groupBy(*keys).agg(*[F.expr(e) for e in exprs])
    return counters, value_counts(batch, value_rules, keys) if value_rules else None


def _range(df: DataFrame, begin: dt.date, end: dt.date) -> DataFrame:
    return df.where(F.col(DAY).between(F.lit(begin), F.lit(end)))


def _read(spark: SparkSession, path: str, table: str, key: str, schema: T.StructType | None) -> DataFrame | None:
    """A table of the state for one suite, or None if there is none."""
    from pyspark.errors import AnalysisException
    try:
        df = (spark.read.schema(schema) if schema else spark.read).parquet(f"{path}/{table}/suite={key}")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return df


def held_days(spark: SparkSession, path: str, key: str, begin: dt.date, end: dt.date) -> list[dt.date]:
    """The days of the range that the state holds; at most one per day of the range."""
    counters = _read(spark, path, "counters", key, None)
    if counters is None:
        return []
    return sorted(r[DAY] for r in _range(counters, begin, end).select(DAY).distinct().collect())


def update_state(batch: DataFrame, suite: Suite, path: str, begin: str | dt.date, end: str | dt.date,
                 by: Sequence[str] = ("project",), again: Sequence[dt.date] = (), end_exclusive: bool = False) -> list[dt.date]:
    """Add the days of ``begin..end`` that the state lacks (and those of ``again``); returns the days that were read.

    The days are a filter on ``dt``, so a source that can prune by day reads nothing else.
    """
    spark = batch.sparkSession
    b, e = P.date_range(begin, end)
    key = state_key(suite, batch.schema, by, end_exclusive)
    held = set(held_days(spark, path, key, b, e)) - set(again)
    wanted = [d for d in (b + dt.timedelta(days=i) for i in range((e - b).days + 1)) if d not in held]
    if not wanted:
        return []
    rows = batch.where(F.col(DAY).isin(wanted)) if held else _range(batch, b, e)
    params = P.merge_params(suite.params, P.day_params(DAY, end_exclusive))
    counters, values = _parts(rows, suite, by, params)
    for name, df in (("values", values), ("counters", counters)):
        if df is not None:
            df.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                .partitionBy(DAY).parquet(f"{path}/{name}/suite={key}")
    return wanted


def results_from_state(spark: SparkSession, path: str, suite: Suite, schema: T.StructType, begin: str | dt.date, end: str | dt.date,
                       by: Sequence[str] = ("project",), per_day: bool = False, end_exclusive: bool = False) -> DataFrame:
    """Results per (``by`` keys, rule) over the days of the range, or per (keys, dt, rule) with days without rows filled in.

    ``schema`` is the batch's.  The days of the range that the state does not hold are missing from the results: update first.
    """
    b, e = P.date_range(begin, end)
    key = state_key(suite, schema, by, end_exclusive)
    counted, value_rules = split_rules(suite.numbered(), schema)
    _, null_cols = metric_sql(counted, schema, P.merge_params(suite.params, P.day_params(DAY, end_exclusive)))
    counters = _read(spark, path, "counters", key, None)
    keys = [*by, DAY] if per_day else list(by)
    if counters is None:
        raise P.BadParameter(f"no state of suite {suite.name!r} below {path}")
    names = [c for c in counters.columns if c.startswith("m_")]
    metrics = _range(counters, b, e).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names])
    entries = None
    if value_rules:
        types = T.StructType([schema[k] for k in by])
        for f in T._parse_datatype_string(VALUE_FIELDS).fields:
            types.add(f)
        values = _read(spark, path, "values", key, types.add(DAY, T.DateType()))
        if values is not None:
            merged = _range(values, b, e).groupBy(*keys, "rule_id", "value", "in_set").agg(F.sum("n").alias("n"))
            entries = entries_of(merged, keys)
    days = (DAY, F.sequence(F.lit(b), F.lit(e))) if per_day else None
    return results_of(with_entries(metrics, entries, keys), suite.numbered(), schema, null_cols, keys, days).select(*keys, *RESULT_COLUMNS)
