"""Resampling to a complete regular grid.

One aggregation covers all columns. Bins without rows are filled in from the distance between a
bin and the next one of its series. The windows that find the next bin see a stretch of bins, or
one row per stretch, however long a series is; the stretches come from a pass over the keys and
times alone. A table without keys is a single series: its bins are spread over tasks and joined to
a range of bins instead, whose ends come from such a pass too. Steps that depend on where a series starts, such as 7 hours,
are made of stored base bins, from which the start is read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationloom.columns import (
    RESAMPLE_TIME_NAMES,
    c,
    classify,
    join_on_keys,
    nan_to_null,
    require_time_column,
    sensor_columns,
)
from stationloom.errors import DataProcessingError, ValidationError
from stationloom.functions.angles import direction
from stationloom.functions.clock import floor_div
from stationloom.functions.frequency import Frequency, parse_frequency
from stationloom.storage import materialize

# Aggregation method and the column-name patterns it is for; anything else is a mean.
METHOD_PATTERNS = {
    "temperature": ("mean", ("Temp", "TC")),
    "humidity": ("mean", ("Humi",)),
    "wind_speed": ("mean", ("Met_Speed",)),
    "wind_direction": ("circular_mean", ("Met_Dir",)),
    "soil_moisture": ("mean", ("SoilMoisture",)),
    "solar_irradiance": ("mean", ("Pyranometer",)),
    "power": ("mean", ("Optimizer",)),
}
METHODS = ("mean", "sum", "circular_mean")
# The next bin is looked for in stretches of this many bins.
STRETCH = 65_536
# Empty bins are made in blocks of this many.
GAP_BLOCK = 65_536


def aggregation_method(name: str, patterns: Mapping[str, tuple[str, Sequence[str]]] = METHOD_PATTERNS) -> str:
    kind = classify(name, {k: p for k, (_, p) in patterns.items()})
    return patterns[kind][0] if kind else "mean"


def _measures(name: str, method: str, i: int) -> list[Column]:
    v = c(name)
    if method == "circular_mean":
        return [F.avg(F.sin(F.radians(v))).alias(f"_a{i}"), F.avg(F.cos(F.radians(v))).alias(f"_b{i}")]
    return [(F.sum(v) if method == "sum" else F.avg(v)).alias(f"_a{i}")]


def _result(method: str, i: int, real: Column) -> Column:
    a = F.when(real, F.col(f"_a{i}"))
    if method == "circular_mean":
        return direction(a, F.when(real, F.col(f"_b{i}")))
    return F.coalesce(a, F.lit(0.0)) if method == "sum" else a


def resample(
    df: DataFrame,
    frequency: str = "1h",
    time_col: str | None = None,
    keys: Sequence[str] = (),
    methods: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per key and bin, from the first to the last bin of each key.

    Missing readings are ignored and rows without a time are left out. A bin with nothing in it is
    NULL, or 0 for a sum. Fixed steps start at midnight of the series' first day and are labelled
    by their start; weeks (to Sunday), months, quarters and years are labelled by their last day.
    ``methods`` names columns that deviate from :data:`METHOD_PATTERNS`.
    """
    time_col = require_time_column(df, time_col, RESAMPLE_TIME_NAMES)
    freq = parse_frequency(frequency)
    names = sensor_columns(df, [time_col, *keys])
    chosen = {n: (methods or {}).get(n) or aggregation_method(n) for n in names}
    for n, m in chosen.items():
        if m not in METHODS:
            raise ValidationError(f"unknown aggregation {m!r} for {n!r}; use one of {METHODS}")
        if not isinstance(df.schema[n].dataType, T.NumericType):
            raise DataProcessingError(f"column {n!r} is not numeric")

    rows = nan_to_null(df).where(c(time_col).isNotNull())
    if freq.needs_origin:
        bins, counted, ordinal = _bins_from_origin(rows, freq, time_col, keys, names, chosen)
        origin = F.col("_origin")
    else:
        ordinal, origin, counted = freq.ordinal(c(time_col)), None, rows
        bins = rows.groupBy(*[c(k) for k in keys], ordinal.alias("_bin")).agg(
            *[m for i, n in enumerate(names) for m in _measures(n, chosen[n], i)]
        )
    if keys:
        bins = _with_last(bins, keys)
        # in two steps, as one array per gap could get as long as the gap
        grid = bins.withColumn("_from", F.explode(F.sequence("_bin", "_last", F.lit(GAP_BLOCK).cast("long"))))
        to = F.least(F.col("_from") + (GAP_BLOCK - 1), F.col("_last"))
        grid = grid.withColumn("_slot", F.explode(F.sequence(F.col("_from"), to)))
    else:
        grid = _single_grid(counted, bins, ordinal, origin)
    real = F.coalesce(F.col("_slot") == F.col("_bin"), F.lit(False))
    return grid.select(
        *[c(k) for k in keys],
        freq.label(F.col("_slot"), origin).alias(time_col),
        *[_result(chosen[n], i, real).alias(n) for i, n in enumerate(names)],
    )


def _with_last(bins: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach ``_last``, the last slot before the next bin of the series.

    The next bin comes from a window over a stretch of ``STRETCH`` bins, and for the last one of a
    stretch from a table with one row per stretch, so no window holds a whole series.
    """
    key_cols = [c(k) for k in keys]
    bins = bins.withColumn("_stretch", floor_div(F.col("_bin"), STRETCH))
    firsts = bins.groupBy(*key_cols, "_stretch").agg(F.min("_bin").alias("_first"))
    later = F.lead("_first").over(Window.partitionBy(*key_cols).orderBy("_stretch"))
    edges = firsts.select(*key_cols, "_stretch", later.alias("_later"))
    inside = F.lead("_bin").over(Window.partitionBy(*key_cols, "_stretch").orderBy("_bin"))
    joined = join_on_keys(bins.withColumn("_inside", inside), edges, [*keys, "_stretch"], "left")
    following = F.coalesce("_inside", "_later")
    return joined.withColumn("_last", F.coalesce(following - 1, F.col("_bin"))).drop("_stretch", "_inside", "_later")


def _single_grid(rows: DataFrame, bins: DataFrame, ordinal: Column, origin: Column | None) -> DataFrame:
    """Bins of the only series with the empty ones between its first and last."""
    origin_or_none = F.lit(None).cast("long") if origin is None else F.min(origin)
    ends = rows.agg(F.min(ordinal).alias("lo"), F.max(ordinal).alias("hi"), origin_or_none.alias("origin")).first()
    if ends["lo"] is None:
        return bins.withColumn("_slot", F.col("_bin"))
    slots = rows.sparkSession.range(ends["lo"], ends["hi"] + 1).withColumnRenamed("id", "_slot")
    grid = slots.join(bins.drop("_origin"), F.col("_slot") == F.col("_bin"), "left")
    return grid.withColumn("_origin", F.lit(ends["origin"]).cast("long"))


def _bins_from_origin(
    rows: DataFrame, freq: Frequency, time_col: str, keys: Sequence[str], names: Sequence[str], chosen: Mapping[str, str]
) -> tuple[DataFrame, DataFrame, Column]:
    """Bins of a step that depends on where a series starts, in two levels and one pass over the readings.

    Base bins, which end wherever a bin or a day could, are stored as sums and counts; the first one of a series gives its
    origin, and they are added up to bins. Returns the bins, the base bins with their origin, and the ordinal of a base bin.
    """
    key_cols = [c(k) for k in keys]

    def parts(n: str, i: int) -> list[Column]:
        v = c(n)
        if chosen[n] == "circular_mean":
            sums = [F.sum(F.sin(F.radians(v))).alias(f"_s{i}"), F.sum(F.cos(F.radians(v))).alias(f"_c{i}")]
            return [*sums, F.count(v).alias(f"_n{i}")]
        return [F.sum(v).alias(f"_s{i}"), F.count(v).alias(f"_n{i}")]

    def whole(n: str, i: int) -> list[Column]:
        mean = lambda part: F.try_divide(F.sum(f"_{part}{i}"), F.sum(f"_n{i}"))
        if chosen[n] == "circular_mean":
            return [mean("s").alias(f"_a{i}"), mean("c").alias(f"_b{i}")]
        if chosen[n] == "sum":
            return [F.sum(f"_s{i}").alias(f"_a{i}")]
        kind = rows.select(F.avg(c(n))).schema[0].dataType
        return [mean("s").cast(kind).alias(f"_a{i}")]

    base = rows.groupBy(*key_cols, freq.base.ordinal(c(time_col)).alias("_base")).agg(
        *[m for i, n in enumerate(names) for m in parts(n, i)]
    )
    base = materialize(base, "base-bins")
    first = base.groupBy(*key_cols).agg(freq.origin_of(F.min("_base")).alias("_origin"))
    if keys:
        base = join_on_keys(base, first, keys)
    else:
        base = base.withColumn("_origin", F.lit(first.first()["_origin"]).cast("long"))
    ordinal = freq.ordinal_of(F.col("_base"), F.col("_origin"))
    bins = base.groupBy(*key_cols, "_origin", ordinal.alias("_bin")).agg(*[m for i, n in enumerate(names) for m in whole(n, i)])
    return bins, base, ordinal


def resample_stats(before: DataFrame, after: DataFrame, frequency: str) -> DataFrame:
    """Rows before and after, and their ratio."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    counts = (
        before.select(one.alias("_in"), none.alias("_out"))
        .unionAll(after.select(none.alias("_in"), one.alias("_out")))
        .agg(
            F.coalesce(F.sum("_in"), none).alias("original_rows"),
            F.coalesce(F.sum("_out"), none).alias("downsampled_rows"),
        )
    )
    return counts.select(
        F.lit(frequency).alias("frequency"),
        "original_rows",
        "downsampled_rows",
        F.coalesce(F.try_divide(F.col("original_rows").cast("double"), F.col("downsampled_rows")), F.lit(0.0)).alias(
            "reduction_factor"
        ),
        F.lit(len(after.columns)).cast("long").alias("columns_processed"),
    )
