"""Resampling frequencies: bins as integer ordinals.

A bin is identified by an ordinal that grows by one from bin to bin, so that a gap between two bins
is the plain integer sequence between them, for fixed steps and calendar periods alike.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from math import gcd

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationloom.errors import ValidationError
from stationloom.functions.clock import DAY, SECOND, floor_div, from_micros, micros

# Frequency units. Microseconds for fixed steps; period name and label side for calendar ones.
FIXED_UNITS = {
    "us": 1, "ms": 1000, "s": SECOND, "S": SECOND, "min": 60 * SECOND, "T": 60 * SECOND, "h": 3600 * SECOND,
    "H": 3600 * SECOND, "D": DAY, "d": DAY,
}
CALENDAR_UNITS = {
    "W": "week", "M": "month", "ME": "month", "Q": "quarter", "QE": "quarter", "Y": "year", "YE": "year", "A": "year",
}
START_UNITS = {"MS": "month", "QS": "quarter", "YS": "year", "AS": "year"}
WEEKDAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")


@dataclass(frozen=True)
class Frequency:
    """``count`` units; ``step`` is the length in microseconds, or None for a calendar period.

    Calendar periods are labelled by their last day, or their first if ``by_start``; a week ends on
    ``week_end`` (0 is Monday).
    """

    count: int
    step: int | None
    period: str | None = None
    by_start: bool = False
    week_end: int = 6

    @property
    def needs_origin(self) -> bool:
        """Whether bins depend on where the series starts (7 h bins do, 1 h and 1 month bins do not)."""
        return DAY % self.step != 0 if self.step else self.count > 1

    @property
    def base(self) -> Frequency:
        """The longest bins that make up both these bins and days (or single periods), wherever a series starts."""
        return replace(self, count=1, step=gcd(self.step, DAY) if self.step else None)

    def origin_of(self, base: Column) -> Column:
        """Start of a series by its first base bin: the midnight before it, or the period itself."""
        if self.step:
            start = base * F.lit(self.base.step).cast("long")
            return start - F.pmod(start, F.lit(DAY).cast("long"))
        return base

    def ordinal_of(self, base: Column, origin: Column) -> Column:
        """The bin that a base bin lies in."""
        if self.step:
            return floor_div(base * F.lit(self.base.step).cast("long") - origin, self.step)
        # the first bin closes with the period the series starts in, or opens with it
        return floor_div(base - origin + (0 if self.by_start else self.count - 1), self.count)

    def ordinal(self, ts: Column) -> Column:
        """The bin of a time, for bins that do not depend on the start of a series."""
        return floor_div(micros(ts), self.step) if self.step else _period_number(ts, self.period, self.week_end)

    def label(self, ordinal: Column, origin: Column | None = None) -> Column:
        """Start of a fixed bin, last or first day of a calendar bin."""
        if self.step:
            start = ordinal * F.lit(self.step).cast("long")
            return from_micros(start if origin is None else start + origin)
        number = ordinal if origin is None else origin + ordinal * F.lit(self.count)
        last = _period_end(number - 1 if self.by_start else number, self.period, self.week_end)
        return (F.date_add(last, 1) if self.by_start else last).cast("timestamp_ntz")

    @property
    def seconds(self) -> int | None:
        return None if self.step is None or self.step % SECOND else self.step // SECOND


def _period_number(ts: Column, period: str, week_end: int) -> Column:
    day = F.to_date(ts)
    if period == "week":  # 1970-01-01 is a Thursday
        return floor_div(F.unix_date(day).cast("long") + (9 - week_end), 7)
    year = F.year(day).cast("long")
    if period == "month":
        return year * 12 + F.month(day) - 1
    if period == "quarter":
        return year * 4 + F.quarter(day) - 1
    return year


def _period_end(number: Column, period: str, week_end: int) -> Column:
    if period == "week":
        return F.date_from_unix_date((number * 7 + (week_end - 3)).cast("int"))
    months = {"month": 1, "quarter": 3, "year": 12}[period]
    # last month of the period, counted from year 0
    last = number * months + (months - 1)
    month, year = F.pmod(last, F.lit(12)) + 1, floor_div(last, 12)
    return F.last_day(F.make_date(year.cast("int"), month.cast("int"), F.lit(1)))


def parse_frequency(text: str) -> Frequency:
    """``'1h'``, ``'1h30min'``, ``'500ms'``, ``'1D'``, ``'W-MON'``, ``'M'``, ``'MS'`` ... as a :class:`Frequency`."""
    if not text:
        raise ValidationError("frequency must not be empty")
    if week := re.fullmatch(r"\s*(\d*)\s*W-([A-Z]{3})\s*", text):
        count = int(week.group(1) or 1)
        if count and week.group(2) in WEEKDAYS:
            return Frequency(count, None, "week", week_end=WEEKDAYS.index(week.group(2)))
    elif re.fullmatch(r"\s*(\d*\s*[A-Za-z]+\s*)+", text):
        parts = [(int(n or 1), unit) for n, unit in re.findall(r"(\d*)\s*([A-Za-z]+)", text)]
        if all(n and unit in FIXED_UNITS for n, unit in parts):
            step = sum(n * FIXED_UNITS[unit] for n, unit in parts)
            return Frequency(parts[0][0] if len(parts) == 1 else 1, step)
        (count, unit), more = parts[0], parts[1:]
        if count and not more and unit in {**CALENDAR_UNITS, **START_UNITS}:
            return Frequency(count, None, {**CALENDAR_UNITS, **START_UNITS}[unit], by_start=unit in START_UNITS)
    raise ValidationError(f"invalid frequency {text!r}; examples: '1h', '1h30min', '1D', 'W-MON', 'MS'")
