"""Arithmetic on naive timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
DAY = 86_400 * SECOND


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00:00; exact in a UTC session."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(value: Column) -> Column:
    return F.timestamp_micros(value).cast("timestamp_ntz")


def floor_div(value: Column, n: int) -> Column:
    """Integer division rounding down, also for times before 1970; stays in 64-bit integers."""
    divisor = F.lit(n).cast("long")
    return F.call_function("div", value - F.pmod(value, divisor), divisor)


def time_chunk(ts: Column, width_seconds: int) -> Column:
    """Number of the time slice that ``ts`` lies in."""
    return floor_div(micros(ts), width_seconds * SECOND)


def month_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def hour_in(ts: Column, start_hour: int, end_hour: int) -> Column:
    """``start_hour <= hour < end_hour``; NULL time is outside."""
    h = F.hour(ts)
    return F.coalesce((h >= start_hour) & (h < end_hour), F.lit(False))
