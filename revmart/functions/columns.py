"""Small Column helpers shared by the jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(value: str | dt.datetime | dt.date) -> Column:
    """A timestamp_ntz literal (plain ``F.lit(datetime)`` would be zone-aware)."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(str(value)).cast("timestamp_ntz")


def hours_after(ts: Column | str, hours: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    hours = F.col(hours) if isinstance(hours, str) else hours
    return F.timestamp_add("HOUR", hours, ts)


def rate_from_units(units: Column, scale: str = "0.0001", dtype: str = "decimal(5,4)") -> Column:
    """Exact decimal rate ``units * 0.0001`` from an integer number of units.

    An integer ``/`` would give a double; the product with a decimal literal
    stays exact.
    """
    return (units * F.lit(scale).cast(dtype)).cast(dtype)


def null_safe_differs(left: list[Column], right: list[Column]) -> Column:
    """True when any pair differs, treating NULL = NULL as equal."""
    cond = F.lit(False)
    for a, b in zip(left, right, strict=True):
        cond = cond | ~a.eqNullSafe(b)
    return cond
