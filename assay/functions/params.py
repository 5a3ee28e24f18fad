"""Job parameters: batch dates, run-time evaluation parameters, typed literals.

Dates are ISO-8601 text parsed on the driver before any job is planned, so a bad
date is a clear error rather than an ANSI cast failure inside a task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import BadParameter

PARAM_KEY = "$PARAMETER"
END_OF_DAY = dt.timedelta(hours=23, minutes=59, seconds=59)
ONE_DAY = dt.timedelta(days=1)


def parse_date(value: str | dt.date) -> dt.date:
    """ISO-8601 calendar date (``YYYY-MM-DD``) -> ``date``; anything else raises."""
    if isinstance(value, dt.datetime):
        raise BadParameter(f"expected a date, got a datetime: {value!r}")
    if isinstance(value, dt.date):
        return value
    try:
        if not isinstance(value, str) or len(value) != 10:
            raise ValueError
        return dt.date.fromisoformat(value)
    except ValueError:
        raise BadParameter(f"not an ISO-8601 date (YYYY-MM-DD): {value!r}") from None


def date_range(begin: str | dt.date, end: str | dt.date) -> tuple[dt.date, dt.date]:
    """Validated inclusive date range; a reversed range is an error."""
    b, e = parse_date(begin), parse_date(end)
    if b > e:
        raise BadParameter(f"begin date {b} is after end date {e}")
    return b, e


def default_query_date(today: dt.date | None = None) -> dt.date:
    """Yesterday in UTC: the default batch date of a daily run."""
    today = today or dt.datetime.now(dt.timezone.utc).date()
    return today - ONE_DAY


def default_query_date_col() -> Column:
    """Same default as a Spark expression (session zone must be UTC)."""
    return F.date_sub(F.current_date(), 1)


def instant_bounds(begin: str | dt.date, end: str | dt.date,
                   end_exclusive: bool = False) -> tuple[dt.datetime, dt.datetime]:
    """UTC instants bounding a date range: begin 00:00:00 and end 23:59:59.

    With ``end_exclusive`` the upper bound is the next midnight (to be compared
    with ``<``).  The bounds are the min and max of the two, so reversed dates
    give the same bounds (as the rule's parameters did in the reference).
    """
    b, e = parse_date(begin), parse_date(end)
    lo = dt.datetime.combine(b, dt.time(), dt.timezone.utc)
    hi = dt.datetime.combine(e, dt.time(), dt.timezone.utc) + (ONE_DAY if end_exclusive else END_OF_DAY)
    return min(lo, hi), max(lo, hi)


def timestamp_params(begin: str | dt.date, end: str | dt.date,
                     end_exclusive: bool = False) -> dict[str, dt.datetime]:
    """Run-time parameters ``min_ts`` / ``max_ts`` for the time-range rule."""
    lo, hi = instant_bounds(begin, end, end_exclusive)
    return {"min_ts": lo, "max_ts": hi}


def day_params(dt_col: str = "dt", end_exclusive: bool = False) -> dict:
    """``min_ts`` / ``max_ts`` bound to each row's own day, for per-day validation."""
    from .sqltext import SqlExpr, ident
    start = f"CAST({ident(dt_col)} AS TIMESTAMP_NTZ)"
    span = "INTERVAL 1 DAY" if end_exclusive else "INTERVAL '23:59:59' HOUR TO SECOND"
    return {"min_ts": SqlExpr(start), "max_ts": SqlExpr(f"{start} + {span}")}


def merge_params(stored: Mapping | None, run: Mapping | None) -> dict:
    """Stored defaults overridden by run-time values (run-time always wins)."""
    merged = dict(stored or {})
    merged.update(run or {})
    return merged


def resolve(value, params: Mapping):
    """Replace ``{"$PARAMETER": name}`` by the parameter's value."""
    if isinstance(value, Mapping) and PARAM_KEY in value:
        name = value[PARAM_KEY]
        if name not in params:
            raise BadParameter(f"evaluation parameter {name!r} has no value")
        return params[name]
    return value


def _to_utc_naive(value) -> dt.datetime:
    if isinstance(value, str):
        try:
            value = dt.datetime.fromisoformat(value.replace("Z", "+00:00"))
        except ValueError:
            raise BadParameter(f"not an ISO-8601 timestamp: {value!r}") from None
    elif isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    if not isinstance(value, dt.datetime):
        raise BadParameter(f"not a timestamp: {value!r}")
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def to_json_value(value):
    """Parameters as JSON-safe values (instants as ISO text with offset)."""
    if isinstance(value, dt.datetime):
        if value.tzinfo is None:
            value = value.replace(tzinfo=dt.timezone.utc)
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value
