"""Fused rule metrics: every row-level rule of a suite in ONE aggregate.

All not-null / between / in-set / regex counts (and the row count) are
``count_if`` expressions of one ``agg`` (or one ``groupBy(keys).agg`` for
per-day runs): one scan, a partial aggregate per task, one tiny final row per
group.  The wide metrics row is then turned into one result row per rule.

A value set given as a DataFrame is never inlined: such rules are counted by value
with the mode rules (``operators.modes``), in one scan for all of them, and the counts
are joined to the union of their sets; Spark broadcasts it if its size in bytes allows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..functions import sqltext as S
from .modes import entries_of, has_value_table, mode_entries, mode_result_parts, outside_sql, value_struct_sql, with_membership

RESULT_SCHEMA = T.StructType([
    T.StructField("rule_id", T.IntegerType(), False),
    T.StructField("rule_type", T.StringType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("mostly", T.DoubleType(), False),
    T.StructField("element_count", T.LongType(), True),
    T.StructField("missing_count", T.LongType(), True),
    T.StructField("unexpected_count", T.LongType(), True),
    T.StructField("unexpected_percent", T.DoubleType(), True),
    T.StructField("observed_value", T.StringType(), True),
    T.StructField("n_modes", T.LongType(), True),
    T.StructField("success", T.BooleanType(), True),
])
RESULT_COLUMNS = tuple(RESULT_SCHEMA.fieldNames())

ENTRIES = "array<struct<rule_id: int, n: bigint, n_modes: bigint, value: string, n_in: bigint, n_out: bigint>>"
NULL_LONG = "CAST(NULL AS BIGINT)"
NULL_DOUBLE = "CAST(NULL AS DOUBLE)"
NULL_STRING = "CAST(NULL AS STRING)"


def result_struct_sql(rule_id: int, rule: R.Rule, element_count: str, missing_count: str,
                      unexpected_count: str, unexpected_percent: str, observed: str, success: str,
                      n_modes: str = NULL_LONG) -> str:
    """``named_struct`` of one result row (field order = ``RESULT_SCHEMA``)."""
    return (
        f"named_struct('rule_id', CAST({int(rule_id)} AS INT), "
        f"'rule_type', {S.string_lit(rule.kind)}, "
        f"'column_name', {S.string_lit(rule.column)}, "
        f"'mostly', {S.number_lit(rule.mostly)}, "
        f"'element_count', CAST(({element_count}) AS BIGINT), "
        f"'missing_count', CAST(({missing_count}) AS BIGINT), "
        f"'unexpected_count', CAST(({unexpected_count}) AS BIGINT), "
        f"'unexpected_percent', CAST(({unexpected_percent}) AS DOUBLE), "
        f"'observed_value', CAST(({observed}) AS STRING), "
        f"'n_modes', CAST(({n_modes}) AS BIGINT), "
        f"'success', ({success}))"
    )


def _m(name: str) -> str:
    return f"coalesce({name}, CAST(0 AS BIGINT))"


def metric_sql(rules: Sequence[tuple[int, R.Rule]], schema: T.StructType, params: Mapping):
    """(aggregate expressions, null-count column per rule column) for the fused aggregate."""
    null_cols: dict[str, str] = {}
    for _, r in rules:
        null_cols.setdefault(r.column, f"m_null_{len(null_cols)}")
    exprs = ["count(1) AS m_n"]
    exprs += [f"count_if({S.ident(c)} IS NULL) AS {m}" for c, m in null_cols.items()]
    for rid, r in rules:
        if r.kind in (R.BETWEEN, R.IN_SET, R.MATCH_REGEX) and not has_value_table(r):
            exprs.append(f"count_if({R.unexpected_sql(r, schema, params)}) AS m_unexp_{rid}")
    return exprs, null_cols


def rule_result_sql(rid: int, r: R.Rule, schema: T.StructType, null_cols: Mapping[str, str]) -> str:
    """Result struct of one rule from the metric columns (and the mode lists)."""
    n = _m("m_n")
    if r.kind == R.OF_TYPE:
        ok, observed = R.type_success(r, schema)
        return result_struct_sql(rid, r, n, NULL_LONG, NULL_LONG, NULL_DOUBLE,
                                 S.string_lit(observed), "true" if ok else "false")
    nulls = _m(null_cols[r.column])
    if r.kind == R.MODE_IN_SET:
        observed, n_modes, success = mode_result_parts(rid)
        return result_struct_sql(rid, r, n, nulls, NULL_LONG, NULL_DOUBLE, observed, success, n_modes)
    if r.kind == R.NOT_NULL:
        return result_struct_sql(rid, r, n, nulls, nulls, R.percent_sql(nulls, n), NULL_STRING,
                                 R.success_sql(f"{n} - {nulls}", n, r.mostly))
    unexp = outside_sql(rid) if has_value_table(r) else _m(f"m_unexp_{rid}")
    nonnull = f"{n} - {nulls}"
    return result_struct_sql(rid, r, n, nulls, unexp, R.percent_sql(unexp, nonnull), NULL_STRING,
                             R.success_sql(f"{nonnull} - {unexp}", nonnull, r.mostly))


def with_entries(metrics: DataFrame, entries: DataFrame | None, keys: list[str]) -> DataFrame:
    """One row per group: the metrics row and the entries of its value counts.

    Both are unioned and folded by a single aggregate on the group keys
    (a global aggregate when there are none, which keeps exactly one row even for
    an empty batch): ``first(ignorenulls)`` for the counts, ``collect_list`` for
    the entries - one per rule and group.  No join, one small shuffle; groups
    with NULL keys are groups like any other.
    """
    if entries is None:
        return metrics.withColumn("frequent", F.lit(None).cast(ENTRIES))
    metric_cols = [c for c in metrics.columns if c not in keys]
    both = metrics.unionByName(entries, allowMissingColumns=True)
    aggs = [F.first(c, ignorenulls=True).alias(c) for c in metric_cols]
    aggs.append(F.collect_list("entry").alias("frequent"))
    return both.groupBy(*keys).agg(*aggs) if keys else both.agg(*aggs)


def one_scan_metrics(batch: DataFrame, exprs: Sequence[str], value_rules: Sequence[tuple[int, R.Rule]],
                     keys: list[str]) -> DataFrame:
    """The same row per group from one scan.

    The batch is pre-aggregated by the keys and the columns of the value rules, with all counters.  Each of those rows
    (one per combination of values, not per row of the batch) gives a row of counters and a row per rule and
    value; counters travel as rule 0 through the aggregates of the value counts.
    """
    columns = list(dict.fromkeys(r.column for _, r in value_rules))
    pre = batch.groupBy(*keys, *[R.col(c).alias(c) for c in columns if c not in keys]).agg(*[F.expr(e) for e in exprs])
    counters = [c for c in pre.columns if c not in keys and c not in columns]
    null = "CAST(NULL AS {})".format
    own = ", ".join(f"'{c}', {c}" for c in counters)
    none = ", ".join(f"'{c}', {NULL_LONG}" for c in counters)
    zero = f"named_struct('rule_id', 0, 'value', '', 'in_set', {null('BOOLEAN')}, 'member', {null('STRING')}, 'n', m_n, {own})"
    structs = [zero, *[value_struct_sql(batch, rid, r, "'n', m_n", none) for rid, r in value_rules]]
    long = pre.selectExpr(*[S.ident(k) for k in keys], f"inline(array({', '.join(structs)}))").where("value IS NOT NULL")
    counts = long.groupBy(*keys, "rule_id", "value", "in_set", "member").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in counters])
    entries = entries_of(with_membership(counts, batch, value_rules), keys, counters)
    aggs = [*[F.sum(c).alias(c) for c in counters], F.collect_list("entry").alias("frequent")]
    return entries.groupBy(*keys).agg(*aggs) if keys else entries.agg(*aggs)


def fill_days(metrics: DataFrame, by: Sequence[str], day: str, days: Column) -> DataFrame:
    """One row per ``by`` group and day of ``days`` (an array), plus the group's row of no day, if it has one.

    The groups come from the metrics themselves: a group's rows (at most one per day) are listed, an empty row for each
    day is put behind them, and one aggregate by day takes what is there.  Work grows with the days, not with their
    square; no scan, no spine to join.
    """
    names = [c for c in metrics.columns if c not in (*by, day)]
    listed = metrics.groupBy(*by).agg(F.collect_list(F.struct(day, *names)).alias("__rows"))
    nothing = [F.lit(None).cast(metrics.schema[c].dataType).alias(c) for c in names]
    every = F.concat("__rows", F.transform(days, lambda d: F.struct(d.alias(day), *nothing)))
    rows = listed.select(*by, F.explode(every).alias("__row")).select(*by, "__row.*")
    return rows.groupBy(*by, day).agg(*[F.first(c, ignorenulls=True).alias(c) for c in names])


def results_of(metrics: DataFrame, rules: Sequence[tuple[int, R.Rule]], schema: T.StructType, null_cols: Mapping[str, str],
               keys: Sequence[str], days: tuple[str, Column] | None = None) -> DataFrame:
    """One result row per (group, rule) from the metrics rows; ``days`` as in ``suite_results``."""
    if days is not None:
        day, array = days
        metrics = fill_days(metrics, [k for k in keys if k != day], day, array)
    structs = ", ".join(rule_result_sql(rid, r, schema, null_cols) for rid, r in rules)
    return metrics.selectExpr(*[S.ident(k) for k in keys], f"inline(array({structs}))")


def split_rules(rules: Sequence[tuple[int, R.Rule]], schema: T.StructType) -> tuple[list, list]:
    """Rules that need counters, and those of them that need value counts."""
    for _, r in rules:
        R.column_type(schema, r.column)
    counted = [(i, r) for i, r in rules if r.kind in R.ROW_KINDS] + [(i, r) for i, r in rules if r.kind == R.MODE_IN_SET]
    return counted, [(i, r) for i, r in counted if r.kind == R.MODE_IN_SET or has_value_table(r)]


def suite_results(batch: DataFrame, rules: Sequence[tuple[int, R.Rule]], params: Mapping,
                  group_cols: Sequence[str] = (), days: tuple[str, Column] | None = None, one_scan: bool | None = None) -> DataFrame | None:
    """One result row per (group, rule) of a whole suite, as ONE plan.

    * row-level rules, row and null counts: one fused aggregate;
    * most-common-value rules and rules with a value table: one value count, folded with the group's
      metrics row by one aggregate;
    * type rules: from the schema.

    ``one_scan`` takes both from one pre-aggregate (``one_scan_metrics``): less to read, and faster where the value rules'
    columns have few combinations.  Left open, it is chosen unless a rule has a value table (a column with many values).
    ``days`` = (name of the day key, array of days) makes days without rows appear
    with zero counts (``fill_days``).
    """
    if not rules:
        return None
    schema, keys = batch.schema, list(group_cols)
    counted, value_rules = split_rules(rules, schema)
    exprs, null_cols = metric_sql(counted, schema, params)
    if one_scan is None:
        one_scan = not any(has_value_table(r) for _, r in value_rules)
    if one_scan and value_rules:
        metrics = one_scan_metrics(batch, exprs, value_rules, keys)
    else:
        entries = mode_entries(batch, value_rules, keys) if value_rules else None
        metrics = with_entries(batch.groupBy(*keys).agg(*[F.expr(e) for e in exprs]), entries, keys)
    return results_of(metrics, rules, schema, null_cols, keys, days)
