"""Value counts: most-common-value rules and in-set rules whose set is a table, from one count.

Plan (no step gathers an unbounded group into one task):

1. ``inline`` one (rule, value, in_set) row per row and rule, then
   ``groupBy(keys, rule, value).count()`` - partial aggregation per task shrinks
   even a value that holds a third of all rows to one row per task.  Membership
   is decided on the typed value, before it becomes text; the members of all value
   tables are one union, joined once to the counts of all their rules.
2. per (keys, rule, count): how many values have that count, the smallest of
   them, how many are in the set; then the row of the largest count per
   (keys, rule), and the rows outside the set.  Both are plain aggregates, however many values tie.
3. that one entry per (keys, rule) is folded together with the fused metrics row
   of its group by one aggregate (see ``operators.metrics``).

Success of a mode rule = exactly one mode (``n_modes``) and it is in the set.  ``observed_value``
is the mode, or the smallest of ``n_modes`` tied ones; ``tied_modes`` lists them all.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import BadParameter
from ..functions import rules as R
from ..functions import sqltext as S


ValueRules = Sequence[tuple[int, R.Rule]]


def has_value_table(rule: R.Rule) -> bool:
    return rule.kind == R.IN_SET and isinstance(rule.kwargs.get("value_set"), DataFrame)


def _member_text(column: str, dtype: T.DataType) -> str:
    """One text per value of a type: what equal values have in common."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return f"CAST(CAST({column} AS DOUBLE) + 0D AS STRING)"  # -0.0 and 0.0 are equal
    return f"CAST(CAST({column} AS {dtype.simpleString()}) AS STRING)"


def _table_type(batch: DataFrame, rule: R.Rule) -> T.DataType:
    """The type that the rule's column and its value table have in common (as in a union of both)."""
    dim = rule.kwargs["value_set"]
    try:
        both = batch.select(R.col(rule.column).alias("v")).union(dim.select(R.col(dim.columns[0]).alias("v")))
        return both.schema["v"].dataType
    except AnalysisException as e:
        raise BadParameter(f"in-set rule on {rule.column}: its value table has another type") from e


def table_members(batch: DataFrame, table_rules: ValueRules) -> DataFrame:
    """(rule_id, member) of the value tables of all rules; NULL is outside a rule's domain."""
    parts = []
    for rid, r in table_rules:
        dim = r.kwargs["value_set"]
        text = _member_text(S.ident(dim.columns[0]), _table_type(batch, r))
        parts.append(dim.selectExpr(f"CAST({int(rid)} AS INT) AS rule_id", f"{text} AS member"))
    return reduce(DataFrame.unionByName, parts).where("member IS NOT NULL").distinct()


def value_struct_sql(batch: DataFrame, rid: int, rule: R.Rule, *more: str) -> str:
    """``named_struct`` (rule_id, value, in_set, member) of a row's value; ``member`` is set for rules with a value table."""
    c = text = S.ident(rule.column)
    dtype = R.column_type(batch.schema, rule.column)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        text = f"CASE WHEN {c} = 0 THEN CAST(0 AS {dtype.simpleString()}) ELSE {c} END"  # -0.0 is no value of its own
    if has_value_table(rule):
        in_set, member = "CAST(NULL AS BOOLEAN)", _member_text(c, _table_type(batch, rule))
    else:
        in_set, member = R.in_set_sql(c, R.value_set_of(rule)), "CAST(NULL AS STRING)"
    return (f"named_struct('rule_id', CAST({int(rid)} AS INT), 'value', CAST({text} AS STRING), 'in_set', {in_set}, "
            f"'member', {member}{''.join(', ' + m for m in more)})")


def with_membership(counts: DataFrame, batch: DataFrame, value_rules: ValueRules) -> DataFrame:
    """``in_set`` of the rules with a value table, from one join of the counts to the members of all of them."""
    tables = [(i, r) for i, r in value_rules if has_value_table(r)]
    if not tables:
        return counts.drop("member")
    found = table_members(batch, tables).withColumn("found", F.lit(True))
    return counts.join(found, ["rule_id", "member"], "left") \
        .withColumn("in_set", F.coalesce("in_set", "found", F.when(F.col("member").isNotNull(), False))).drop("member", "found")


def value_counts(batch: DataFrame, value_rules: ValueRules, group_cols: Sequence[str] = ()) -> DataFrame:
    """(keys, rule_id, value, in_set, n) of the non-null values of every rule's column; one scan, whatever the rules."""
    keys = [S.ident(k) for k in group_cols]
    pairs = ", ".join(value_struct_sql(batch, rid, rule) for rid, rule in value_rules)
    long = batch.selectExpr(*keys, f"inline(array({pairs}))").where("value IS NOT NULL")
    counts = long.groupBy(*group_cols, "rule_id", "value", "in_set", "member").agg(F.count(F.lit(1)).alias("n"))
    return with_membership(counts, batch, value_rules)


def entries_of(counts: DataFrame, group_cols: Sequence[str] = (), carried: Sequence[str] = ()) -> DataFrame:
    """(keys, entry) of value counts: one struct (rule_id, n, n_modes, value, n_in, n_out) per (group, rule) with values.

    ``carried`` columns are summed along (``operators.metrics`` sends its counters through with rule 0).
    """
    keys = list(group_cols)
    per_count = counts.groupBy(*keys, "rule_id", "n").agg(
        F.count(F.lit(1)).alias("n_modes"), F.min("value").alias("value"), F.count_if("in_set").alias("n_in"),
        *[F.sum(c).alias(c) for c in carried])
    top = per_count.groupBy(*keys, "rule_id").agg(
        F.max(F.struct("n", "n_modes", "value", "n_in")).alias("top"),
        F.sum(F.col("n") * (F.col("n_modes") - F.col("n_in"))).alias("n_out"), *[F.sum(c).alias(c) for c in carried])
    entry = F.struct("rule_id", "top.*", "n_out")
    return top.select(*keys, (F.when(F.col("rule_id") > 0, entry) if carried else entry).alias("entry"), *carried)


def mode_entries(batch: DataFrame, value_rules: ValueRules, group_cols: Sequence[str] = ()) -> DataFrame:
    return entries_of(value_counts(batch, value_rules, group_cols), group_cols)


def _mine(rid: int) -> str:
    return f"get(filter(coalesce(frequent, array()), x -> x.rule_id = {int(rid)}), 0)"


def outside_sql(rid: int) -> str:
    """Rows outside the value table of a rule, over the ``frequent`` list column of a metrics row."""
    return f"coalesce({_mine(rid)}.n_out, CAST(0 AS BIGINT))"


def mode_result_parts(rid: int) -> tuple[str, str, str]:
    """(observed value, number of modes, success) SQL over the ``frequent`` list column of a metrics row."""
    mine = _mine(rid)
    return (f"{mine}.value", f"coalesce({mine}.n_modes, CAST(0 AS BIGINT))",
            f"coalesce({mine}.n_modes = 1 AND {mine}.n_in = 1, false)")


def mode_results(batch: DataFrame, mode_rules: Sequence[tuple[int, R.Rule]],
                 group_cols: Sequence[str] = ()) -> DataFrame | None:
    """Results of mode rules alone (the fused plan with only these rules)."""
    from .metrics import suite_results
    return suite_results(batch, mode_rules, {}, group_cols)


def tied_modes(batch: DataFrame, mode_rules: Sequence[tuple[int, R.Rule]],
               group_cols: Sequence[str] = ()) -> DataFrame:
    """(keys, rule_id, column_name, value, n): every value that has the largest count of its group and rule."""
    keys = list(group_cols)
    counts = value_counts(batch, mode_rules, keys)
    top = counts.groupBy(*keys, "rule_id").agg(F.max("n").alias("top_n")) \
        .select(*[R.col(k).alias(f"__{k}") for k in keys], F.col("rule_id").alias("__rule"), "top_n")
    same = (F.col("rule_id") == F.col("__rule")) & (F.col("n") == F.col("top_n"))
    for k in keys:
        same = same & R.col(k).eqNullSafe(R.col(f"__{k}"))
    names = " ".join(f"WHEN {int(rid)} THEN {S.string_lit(r.column)}" for rid, r in mode_rules)
    return counts.join(top, same, "left_semi").selectExpr(
        *[S.ident(k) for k in keys], "rule_id", f"CASE rule_id {names} END AS column_name", "value", "n")
