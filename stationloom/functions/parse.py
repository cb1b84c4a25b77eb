"""Text to typed values; what cannot be read becomes NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Format of the weather station's Date and Time columns put together.
DATE_TIME_FORMAT = "yyyy/MM/dd HH:mm:ss"


def parse_time(text: Column, formats: Sequence[str] = ()) -> Column:
    """ISO-like text, else the first of ``formats`` that fits, else NULL."""
    attempts = [text.try_cast("timestamp_ntz")]
    attempts += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*attempts)


def parse_date_and_time(date: Column, time: Column, fmt: str = DATE_TIME_FORMAT) -> Column:
    """Two text columns read with one strict format; NULL if either is missing."""
    return F.try_to_timestamp(F.concat(date, F.lit(" "), time), F.lit(fmt)).cast("timestamp_ntz")


def parse_number(text: Column) -> Column:
    """A double, or NULL. The cast would also take Java literals such as ``1.5f``; those are not numbers."""
    trimmed = F.lower(F.rtrim(text))
    java_suffix = F.substring(trimmed, -1, 1).isin("d", "f") & (F.substring(trimmed, -3, 3) != "inf")
    number = text.try_cast("double")
    return F.when(~F.isnan(number) & ~java_suffix, number)
