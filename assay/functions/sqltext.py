"""Spark SQL expression text: identifiers and typed literals.

Rule metrics are written as SQL expressions (``F.expr`` / ``selectExpr``): one
call per expression instead of one JVM round trip per literal and operator,
which keeps planning a 20-rule suite in milliseconds.  The plans are the same.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

from pyspark.sql import types as T

from ..errors import BadParameter


class SqlExpr(str):
    """A parameter given as a per-row SQL expression (e.g. bounds of each row's day)."""


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def string_lit(value: str) -> str:
    """Quoted string literal (default parser: backslash escapes)."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def number_lit(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    value = float(value)
    if math.isnan(value) or math.isinf(value):
        raise BadParameter(f"non-finite number in a rule: {value}")
    return f"CAST({value!r} AS DOUBLE)"


def _utc_naive(value) -> dt.datetime:
    from .params import _to_utc_naive
    return _to_utc_naive(value)


def typed_lit(value, dtype: T.DataType) -> str:
    """A literal (or per-row expression) of the column's own type."""
    if isinstance(value, SqlExpr):
        return f"CAST(({value}) AS {dtype.simpleString()})"
    if value is None:
        return f"CAST(NULL AS {dtype.simpleString()})"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        naive = _utc_naive(value).isoformat(sep=" ", timespec="microseconds")
        if isinstance(dtype, T.TimestampType):
            return f"CAST({string_lit(naive + '+00:00')} AS TIMESTAMP)"
        return f"CAST({string_lit(naive)} AS TIMESTAMP_NTZ)"
    if isinstance(dtype, T.DateType):
        from .params import parse_date
        if isinstance(value, dt.datetime):
            value = value.date()
        return f"DATE {string_lit(parse_date(value).isoformat())}"
    if isinstance(dtype, T.StringType):
        return string_lit(value)
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return f"CAST({number_lit(value)} AS {dtype.simpleString()})"
    return f"CAST({string_lit(value)} AS {dtype.simpleString()})"


def compare_sql(column: str, op: str, value, dtype: T.DataType) -> str:
    """``column op value`` compared in the wider type: a bound is never narrowed to the column's type.

    Whole-number columns meet fractions as exact decimals, dates meet instants as
    instants (a date is its first moment).
    """
    if not isinstance(value, SqlExpr) and value is not None:
        if isinstance(dtype, T.DateType) and _has_time(value):
            return f"CAST({column} AS TIMESTAMP_NTZ) {op} {typed_lit(value, T.TimestampNTZType())}"
        if isinstance(dtype, (T.IntegralType, T.DecimalType)) and not isinstance(value, bool):
            if isinstance(value, float) and (math.isnan(value) or math.isinf(value)):
                raise BadParameter(f"non-finite number in a rule: {value}")
            if isinstance(value, (int, float, decimal.Decimal)):
                return f"{column} {op} {format(decimal.Decimal(str(value)), 'f')}BD"
    return f"{column} {op} {typed_lit(value, dtype)}"


def _has_time(value) -> bool:
    return isinstance(value, dt.datetime) or isinstance(value, str) and len(value) > 10


def value_lit(value) -> str:
    """Literal of a value-set member (strings, numbers, booleans)."""
    if isinstance(value, str):
        return string_lit(value)
    if isinstance(value, (int, float)):
        return number_lit(value)
    if isinstance(value, decimal.Decimal):
        return f"{format(value, 'f')}BD"
    if isinstance(value, dt.datetime):
        return typed_lit(value, T.TimestampNTZType())
    if isinstance(value, dt.date):
        return typed_lit(value, T.DateType())
    raise BadParameter(f"unsupported value in a value set: {value!r}")
