"""Datasets for analysis: selected and renamed columns, a period, joined sources, splits at a date."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationloom.columns import c, matching
from stationloom.errors import ValidationError

# Name parts of the columns that are split at a date unless told otherwise.
SPLIT_PATTERNS = ("WedTri", "WT")


def select_rename(df: DataFrame, columns: Mapping[str, str] | None) -> DataFrame | None:
    """Old name to new name; absent columns are skipped, and without any there is no dataset (None).

    No mapping keeps the table as it is.
    """
    if not columns:
        return df
    present = [n for n in columns if n in df.columns]
    return df.select(*[c(n).alias(columns[n]) for n in present]) if present else None


def date_range(
    df: DataFrame, time_col: str, start: str | None, end: str | None, end_inclusive_day: bool = False
) -> DataFrame:
    """Rows from ``start`` to ``end``, both midnights: of the end date only 00:00:00 is in.

    ``end_inclusive_day`` takes all of the end date. A bound that is None is open.
    """
    ts = c(time_col)
    kept = ts.isNotNull()
    if start is not None:
        kept = kept & (ts >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        last = F.lit(end).cast("timestamp_ntz")
        kept = kept & ((ts < last + F.expr("INTERVAL 1 DAY")) if end_inclusive_day else (ts <= last))
    return df.where(kept)


def join_sources(
    df: DataFrame, sources: Sequence[tuple[DataFrame, Mapping[str, str]]], on: Sequence[str]
) -> DataFrame:
    """Inner join with the selected columns of each source.

    A source with none of its columns is skipped. A column name that two sides share is an error;
    rename it in the mapping.
    """
    for other, columns in sources:
        present = [n for n in columns if n in other.columns]
        if not present:
            continue
        clash = [columns[n] for n in present if columns[n] in df.columns]
        if clash:
            raise ValidationError(f"columns {clash} exist on both sides of the join")
        df = df.join(other.select(*[c(k) for k in on], *[c(n).alias(columns[n]) for n in present]), list(on), "inner")
    return df


def _sides(time_col: str, split_date: str) -> tuple[Column, Column]:
    at = F.lit(split_date).cast("timestamp_ntz")
    return c(time_col) < at, c(time_col) >= at


def split_rows_by_date(
    df: DataFrame, time_col: str, split_date: str, part1: str = "_part1", part2: str = "_part2"
) -> DataFrame:
    """Column ``part`` says on which side of the date a row lies; rows without a time are in neither part.

    Write it with ``partitionBy("part")`` to get the parts apart; an empty part has no files.
    """
    before, since = _sides(time_col, split_date)
    return df.withColumn("part", F.when(before, part1).when(since, part2)).where(F.col("part").isNotNull())


def split_columns_by_date(
    df: DataFrame,
    time_col: str,
    split_date: str,
    patterns: Sequence[str] = SPLIT_PATTERNS,
    part1: str = "_part1",
    part2: str = "_part2",
    keep_original: bool = False,
) -> DataFrame | None:
    """Each matching column as two, one holding the values before the date and one those since; None if none match."""
    chosen = matching(df.columns, patterns, [time_col])
    if not chosen:
        return None
    before, since = _sides(time_col, split_date)
    kept = [n for n in df.columns if keep_original or n not in chosen]
    halves = [
        half
        for n in chosen
        for half in (F.when(before, c(n)).alias(n + part1), F.when(since, c(n)).alias(n + part2))
    ]
    return df.select(*[c(n) for n in kept], *halves)


def split_stats(df: DataFrame, time_col: str, split_date: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows in all, before the date and since."""
    before, since = _sides(time_col, split_date)
    return df.groupBy(*[c(k) for k in keys]).agg(
        F.count("*").alias("total_records"),
        F.count_if(before).alias("part1_records"),
        F.count_if(since).alias("part2_records"),
    )
