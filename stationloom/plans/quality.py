"""Quality control of a table: constant runs, then failure windows, then ranges."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationloom.columns import c, matching, nan_to_null, sensor_columns
from stationloom.operators import constant, masks
from stationloom.rules import ConstantRule, FailureWindow, RangeRule
from stationloom.storage import materialize


@dataclass(frozen=True)
class QualityRules:
    ranges: Sequence[RangeRule] = ()
    constants: Sequence[ConstantRule] = ()
    failures: Sequence[FailureWindow] = ()


@dataclass(frozen=True)
class QualityResult:
    """Masked table and, for the steps that had something to do, their statistics (computed on demand)."""

    table: DataFrame
    stats: dict[str, DataFrame] = field(default_factory=dict)


def quality_control(
    df: DataFrame,
    rules: QualityRules,
    time_col: str,
    keys: Sequence[str] = (),
    station: Column | None = None,
    exclude: Sequence[str] = (),
    store_stats: bool = False,
) -> QualityResult:
    """The three masks in their order; the two row-wise ones end up in one projection.

    ``station`` gives the key by which failure windows are looked up. ``store_stats`` counts what
    failure windows and ranges mask right away; otherwise each statistic is a query of its own, run
    when it is used.
    """
    stats: dict[str, DataFrame] = {}
    df = nan_to_null(df)
    fixed = [*keys, *exclude]
    sensors = sensor_columns(df, [time_col, *fixed])
    if any(matching(sensors, r.patterns) for r in rules.constants):
        # the flagged days are read for the mask and for the statistics
        flagged = materialize(
            constant.constant_days(df, rules.constants, time_col, keys, exclude), "flagged-days"
        )
        stats["constant_values"] = constant.constant_stats(flagged, keys)
        df = constant.constant_mask(df, flagged, time_col, keys)

    failures = [w for w in rules.failures if matching(sensors, w.sensors)] if station is not None else []
    if failures:
        found = masks.failure_stats(df, failures, station, time_col, exclude, keys=keys)
        stats["failures"] = materialize(found, "failure-counts") if store_stats else found
        df = masks.failure_mask(df, failures, station, time_col, fixed)
    ranged = any(matching(sensors, r.patterns) for r in rules.ranges)
    if ranged:
        stats["boundaries"] = masks.range_stats(df, rules.ranges, time_col, keys, exclude)
        if store_stats:
            counts = masks.range_counts(df, rules.ranges, time_col, fixed)
            counted = materialize(df.groupBy(*[c(k) for k in keys]).agg(*counts.measures), "quality-counts")
            stats["boundaries"] = counts.read(counted, keys)
    if ranged:
        df = masks.range_mask(df, rules.ranges, time_col, fixed)
    return QualityResult(df, stats)


def total_flagged(result: QualityResult) -> DataFrame:
    """Readings flagged by constant runs and ranges together; failure windows count rows and are left out."""
    parts = [result.stats[k].select("flagged_count") for k in ("constant_values", "boundaries") if k in result.stats]
    if not parts:
        return result.table.limit(0).agg(F.count("*").alias("total_flagged"))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionAll(p)
    return every.agg(F.coalesce(F.sum("flagged_count"), F.lit(0).cast("long")).alias("total_flagged"))
