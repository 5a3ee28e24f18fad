"""Column rules and the Spark expressions that measure them.

A rule is (kind, column, mostly, arguments).  Kinds carry the public names of the
validation library the reference used, so a suite written for it reads the same
here.  Row-level kinds compile to a boolean "unexpected" predicate per row; the
counts of all of them are taken in one aggregate (see ``operators.metrics``).

Semantics (per kind):

* not null: every row counts; success = (n - nulls) / n >= mostly; n = 0 passes.
* between / in set / regex: nulls are excluded; success =
  (nonnull - unexpected) / nonnull >= mostly; nonnull = 0 passes.
* type: the column's Spark type, no job.
* most common value in set: nulls excluded; passes only if there is exactly one
  mode and it is in the set; an empty column fails.
"""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import BadParameter, SchemaDriftError
from . import params as P
from . import sqltext as S
from .types import type_matches

NOT_NULL = "expect_column_values_to_not_be_null"
OF_TYPE = "expect_column_values_to_be_of_type"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
MODE_IN_SET = "expect_column_most_common_value_to_be_in_set"
MATCH_REGEX = "expect_column_values_to_match_regex"

ROW_KINDS = (NOT_NULL, BETWEEN, IN_SET, MATCH_REGEX)
ALL_KINDS = ROW_KINDS + (OF_TYPE, MODE_IN_SET)


@dataclasses.dataclass
class Rule:
    kind: str
    column: str
    mostly: float = 1.0
    kwargs: dict = dataclasses.field(default_factory=dict)

    def __post_init__(self):
        if self.kind not in ALL_KINDS:
            raise BadParameter(f"unknown rule kind {self.kind!r}")
        if self.mostly is None:
            self.mostly = 1.0
        if not 0.0 <= float(self.mostly) <= 1.0:
            raise BadParameter(f"mostly must be within [0, 1], got {self.mostly}")
        self.mostly = float(self.mostly)

    @property
    def key(self) -> tuple[str, str]:
        """Identity in a suite: a second rule with the same key replaces the first."""
        return self.kind, self.column

    def kwargs_json(self) -> str:
        def enc(v):
            if isinstance(v, DataFrame):
                raise BadParameter("a rule with a DataFrame value set cannot be stored")
            if isinstance(v, (set, frozenset, tuple)):
                return sorted(v) if isinstance(v, (set, frozenset)) else list(v)
            return P.to_json_value(v)

        return json.dumps({k: enc(v) for k, v in sorted(self.kwargs.items())}, sort_keys=True)

    @classmethod
    def from_json(cls, kind: str, column: str, mostly: float, kwargs_json: str) -> "Rule":
        return cls(kind, column, mostly, json.loads(kwargs_json or "{}"))


def col(name: str) -> Column:
    """Column by exact name (dots in a flat name are not struct access)."""
    return F.col("`" + name.replace("`", "``") + "`")


def column_type(schema: T.StructType, name: str) -> T.DataType:
    if name not in schema.fieldNames():
        raise SchemaDriftError(f"rule column {name!r} is not in the batch {schema.fieldNames()}")
    return schema[name].dataType


def value_set_of(rule: Rule):
    values = rule.kwargs.get("value_set")
    if values is None:
        raise BadParameter(f"{rule.kind} on {rule.column} needs value_set")
    return values


def literal_values(values) -> list:
    """A value set given as a collection, de-duplicated and sorted (stable plans)."""
    return sorted(set(values), key=lambda v: (v is None, str(v)))


def in_set_sql(column: str, values) -> str:
    """TRUE / FALSE for a non-null column value; members are compared by type, not as text."""
    members = [v for v in literal_values(values) if v is not None]  # NULL is outside the rule's domain
    return f"{column} IN ({', '.join(S.value_lit(v) for v in members)})" if members else "false"


def unexpected_sql(rule: Rule, schema: T.StructType, params: Mapping) -> str:
    """SQL boolean expression: TRUE where the row breaks a row-level rule.

    For between / in set / regex a NULL value gives NULL (neither expected nor
    unexpected), so ``count_if`` skips it: that is the "nulls excluded" rule.
    """
    c = S.ident(rule.column)
    dtype = column_type(schema, rule.column)
    if rule.kind == NOT_NULL:
        return f"{c} IS NULL"
    if rule.kind == BETWEEN:
        lo = P.resolve(rule.kwargs.get("min_value"), params)
        hi = P.resolve(rule.kwargs.get("max_value"), params)
        if lo is None and hi is None:
            raise BadParameter(f"between rule on {rule.column} needs min_value or max_value")
        ok = []
        if lo is not None:
            ok.append(S.compare_sql(c, ">" if rule.kwargs.get("strict_min") else ">=", lo, dtype))
        if hi is not None:
            ok.append(S.compare_sql(c, "<" if rule.kwargs.get("strict_max") else "<=", hi, dtype))
        return f"NOT ({' AND '.join(ok)})"
    if rule.kind == IN_SET:
        return f"CASE WHEN {c} IS NOT NULL THEN NOT ({in_set_sql(c, value_set_of(rule))}) END"
    if rule.kind == MATCH_REGEX:
        regex = rule.kwargs.get("regex")
        if not regex:
            raise BadParameter(f"regex rule on {rule.column} needs regex")
        text = c if isinstance(dtype, T.StringType) else f"CAST({c} AS STRING)"  # values as text
        return f"NOT ({text} RLIKE {S.string_lit(regex)})"
    raise BadParameter(f"{rule.kind} is not a row-level rule")


def type_success(rule: Rule, schema: T.StructType) -> tuple[bool, str]:
    dtype = column_type(schema, rule.column)
    type_name = rule.kwargs.get("type_")
    if not type_name:
        raise BadParameter(f"type rule on {rule.column} needs type_")
    return type_matches(dtype, type_name), dtype.simpleString()


def success_sql(good: str, total: str, mostly: float) -> str:
    """``total = 0`` passes; else ``good / total >= mostly`` (no divide by zero)."""
    return (f"CASE WHEN ({total}) = 0 THEN true ELSE "
            f"try_divide(CAST(({good}) AS DOUBLE), CAST(({total}) AS DOUBLE)) >= {S.number_lit(mostly)} END")


def percent_sql(part: str, total: str) -> str:
    return f"round(try_divide(CAST(({part}) AS DOUBLE) * 100.0, CAST(({total}) AS DOUBLE)), 6)"
