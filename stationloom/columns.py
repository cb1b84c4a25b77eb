"""Column names: quoting, pattern rules and time-column detection.

Schemas are known when a plan is built, so everything here runs on plain names in the driver and
ends up as an ordinary ``select``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationloom.errors import ValidationError

# Time-column candidates, in order of preference.
POWER_TIME_NAMES = ("DateTime", "Time", "Timestamp")
QC_TIME_NAMES = ("datetime", "DateTime")
RESAMPLE_TIME_NAMES = ("DateTime", "datetime", "Timestamp", "timestamp")


def c(name: str) -> Column:
    """The column of that exact name; sensor names hold dots, blanks and brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def time_column(names: Sequence[str], candidates: Iterable[str], default: str | None = None) -> str | None:
    """First candidate that is present, else ``default``."""
    present = set(names)
    return next((n for n in candidates if n in present), default)


def require_time_column(df: DataFrame, name: str | None, candidates: Iterable[str]) -> str:
    """The named time column, or the detected one; fails when there is none."""
    if name is None:
        name = time_column(df.columns, candidates)
        if name is None:
            raise ValidationError(f"no time column among {df.columns}; name it with time_col")
    elif name not in df.columns:
        raise ValidationError(f"time column {name!r} not found among {df.columns}")
    return name


def classify(name: str, rules: Mapping[str, Sequence[str]]) -> str | None:
    """Key of the first rule one of whose patterns is a (case-sensitive) part of ``name``."""
    return next((key for key, patterns in rules.items() if any(p in name for p in patterns)), None)


def classify_expr(name: Column, rules: Mapping[str, Sequence[str]], default: str | None = None) -> Column:
    """:func:`classify` for names held as data (long tables)."""
    branches = F.lit(default)
    for key, patterns in reversed(list(rules.items())):
        hit = F.lit(False)
        for p in patterns:
            hit = hit | name.contains(p)
        branches = F.when(hit, F.lit(key)).otherwise(branches)
    return branches


def matching(names: Iterable[str], patterns: Sequence[str], exclude: Iterable[str] = ()) -> list[str]:
    """Names that contain any of the patterns, in table order."""
    skip = set(exclude)
    return [n for n in names if n not in skip and any(p in n for p in patterns)]


def sensor_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    skip = set(exclude)
    return [n for n in df.columns if n not in skip]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is missing. Spark orders NaN above every number, so it has to go before any comparison."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.when(~F.isnan(c(f.name)), c(f.name)).alias(f.name) if isinstance(f.dataType, floating) else c(f.name)
            for f in df.schema.fields
        ]
    )


def unpivot_stats(df: DataFrame, keys: Sequence[str], entries: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One row per entry from a table whose columns hold the figures of all entries."""
    rows = F.array(*[F.struct(*[v.alias(k) for k, v in e.items()]) for e in entries])
    return df.select(*[c(k) for k in keys], F.inline(rows))


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same names, NULL keys meeting NULL keys; the keys of ``left`` stay."""
    renamed = right.select(*[c(n).alias(f"_right_{n}") if n in keys else c(n) for n in right.columns])
    on = F.lit(True)
    for k in keys:
        on = on & c(k).eqNullSafe(c(f"_right_{k}"))
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in keys])
