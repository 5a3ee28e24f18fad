"""Unexpected values of row-level rules, all of them (one pass for all rules).

Each row emits one (rule, value) pair per rule it breaks; the pairs are counted
(partial aggregation first), so the listing has a row per distinct value.  A value
set given as a DataFrame is joined to the column's value counts, all such rules in one scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import sqltext as S
from .modes import has_value_table, value_counts


def unexpected_values(batch: DataFrame, rules: Sequence[tuple[int, R.Rule]], params: Mapping,
                      group_cols: Sequence[str] = ()) -> DataFrame | None:
    """(keys, rule_id, column_name, value, n): every unexpected value per (group, rule).

    A NULL value is what a not-null rule reports.  ``group_cols`` makes each group
    of rows its own batch (e.g. per project and day).  Give the failed rules only.
    """
    keys = list(group_cols)
    row_rules = [(i, r) for i, r in rules if r.kind in R.ROW_KINDS]
    if not row_rules:
        return None
    schema = batch.schema
    parts = []
    inline_rules = [(rid, r) for rid, r in row_rules if not has_value_table(r)]
    if inline_rules:
        pairs = ", ".join(
            f"CASE WHEN coalesce({R.unexpected_sql(r, schema, params)}, false) "
            f"THEN named_struct('rule_id', CAST({int(rid)} AS INT), 'value', CAST({S.ident(r.column)} AS STRING)) END"
            for rid, r in inline_rules)
        # explode + where stay in whole-stage codegen (a lambda filter would not)
        hits = (batch.selectExpr(*[S.ident(c) for c in keys], f"explode(array({pairs})) AS p")
                .where("p IS NOT NULL").select(*keys, "p.*"))
        parts.append(hits.groupBy(*keys, "rule_id", "value").agg(F.count(F.lit(1)).alias("n")))
    table_rules = [(rid, r) for rid, r in row_rules if has_value_table(r)]
    if table_rules:
        parts.append(value_counts(batch, table_rules, keys).where("NOT in_set").select(*keys, "rule_id", "value", "n"))
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    names = " ".join(f"WHEN {int(rid)} THEN {S.string_lit(r.column)}" for rid, r in row_rules)
    return counts.selectExpr(*[S.ident(c) for c in keys], "rule_id", f"CASE rule_id {names} END AS column_name",
                             "value", "n")


def top_values(values: DataFrame, k: int, group_cols: Sequence[str] = ()) -> DataFrame:
    """The ``k`` most frequent rows of ``unexpected_values`` per (group, rule), with ``rank``; ties by value.

    ``row_number() <= k`` is planned as a per-task limit before the shuffle and a
    final one after it, so no rule's values meet in one task unbounded.
    """
    w = Window.partitionBy(*group_cols, "rule_id").orderBy(F.col("n").desc(), F.col("value").asc_nulls_first())
    return values.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
