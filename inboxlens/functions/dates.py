"""Date arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sql import q

_UNITS = ("minute", "hour", "day")


def utc_sql(expr: str) -> str:
    """SQL text of the UTC wall-clock time (zone-free) of a zoned timestamp.

    Counted from the epoch, so it depends neither on the session time zone nor
    on its daylight-saving gaps."""
    seconds = f"CAST(unix_micros({expr}) AS DECIMAL(20, 0)) / 1000000"
    return f"(timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds}))"


def boundary_diff(unit: str, start: str | Column, end: str | Column) -> Column:
    """Number of ``unit`` boundaries crossed from ``start`` to ``end``
    (warehouse ``datediff`` semantics, not whole units elapsed):
    22:58:40 -> 23:00:05 is 2 minutes and 1 hour.

    Computed from calendar fields (day number, hour, minute), so it never
    depends on the session time zone for zone-free timestamps and stays in
    generated code.  NULL if either side is NULL.  Returns bigint.
    """
    if unit not in _UNITS:
        raise ValueError(f"unit must be one of {_UNITS}")
    if isinstance(start, str) and isinstance(end, str):
        a, b = q(start), q(end)
        days = f"CAST(date_diff(to_date({b}), to_date({a})) AS BIGINT)"
        hours = f"({days} * 24 + (hour({b}) - hour({a})))"
        sql = {"day": days, "hour": hours,
               "minute": f"({hours} * 60 + (minute({b}) - minute({a})))"}[unit]
        return F.expr(sql)
    a = F.col(start) if isinstance(start, str) else start
    b = F.col(end) if isinstance(end, str) else end
    days = F.date_diff(F.to_date(b), F.to_date(a)).cast("bigint")
    if unit == "day":
        return days
    hours = days * 24 + (F.hour(b) - F.hour(a))
    if unit == "hour":
        return hours
    return hours * 60 + (F.minute(b) - F.minute(a))
