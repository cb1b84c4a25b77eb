"""Stuck sensors: runs of days on which a sensor does not vary.

The readings are reduced to one row per key and day first (partial aggregation, so a hot station
costs no more than another); runs are found on that day table, whose size depends on the calendar
and not on the number of readings. Flagged days go back to the readings through a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationloom.columns import c, matching, nan_to_null, sensor_columns
from stationloom.errors import ValidationError
from stationloom.rules import ConstantRule
from stationloom.storage import materialize


def daily_std(df: DataFrame, time_col: str, keys: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """Sample standard deviation per key, day and column (wide); NULL for a day with fewer than two readings.

    Days are those that have a row; rows without a time are left out.
    """
    columns = sensor_columns(df, [time_col, *keys]) if columns is None else columns
    day = F.to_date(c(time_col)).alias("day")
    return (
        nan_to_null(df).where(c(time_col).isNotNull())
        .groupBy(*[c(k) for k in keys], day)
        .agg(F.count("*").alias("rows"), *[F.stddev_samp(c(n)).alias(n) for n in columns])
    )


def constant_days(
    df: DataFrame,
    rules: Sequence[ConstantRule],
    time_col: str,
    keys: Sequence[str] = (),
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Days to mask: ``(keys, sensor, category, day, rows, window_days, tolerance)``.

    A day is constant if its deviation is below the tolerance. In a run of constant days (days
    without rows do not interrupt it) every complete block of ``window_days`` is flagged. A column
    that belongs to several categories is judged by each in turn, the later ones no longer seeing
    the days flagged before.
    """
    sensors = sensor_columns(df, [time_col, *keys, *exclude])
    turns: dict[str, list[ConstantRule]] = {}
    for rule in rules:
        for n in matching(sensors, rule.patterns):
            turns.setdefault(n, []).append(rule)
    if not turns:
        raise ValidationError("no column is covered by a constant-run rule")

    daily = daily_std(df, time_col, keys, list(turns))
    key_cols = [c(k) for k in keys]
    days = daily.select(
        *key_cols, "day", "rows",
        F.inline(F.array(*[F.struct(F.lit(n).alias("sensor"), c(n).alias("std")) for n in turns])),
    ).withColumn("flagged", F.lit(None).cast("int"))
    for turn in range(max(len(r) for r in turns.values())):
        # sensors without a rule for this turn get no tolerance, hence no constant day
        tolerance, window = F.lit(None).cast("double"), F.lit(None).cast("int")
        for n, own in turns.items():
            if len(own) > turn:
                tolerance = F.when(F.col("sensor") == n, F.lit(own[turn].tolerance)).otherwise(tolerance)
                window = F.when(F.col("sensor") == n, F.lit(own[turn].window_days)).otherwise(window)
        days = _flag_runs(days, keys, turn, tolerance, window)

    flagged = days.where(F.col("flagged").isNotNull())
    pick = lambda attribute, kind: F.coalesce(
        *[
            F.when((F.col("sensor") == n) & (F.col("flagged") == i), F.lit(getattr(r, attribute)).cast(kind))
            for n, own in turns.items()
            for i, r in enumerate(own)
        ]
    )
    return flagged.select(
        *key_cols, "sensor", pick("category", "string").alias("category"), "day", "rows",
        pick("window_days", "int").alias("window_days"), pick("tolerance", "double").alias("tolerance"),
    )


def _flag_runs(days: DataFrame, keys: Sequence[str], turn: int, tolerance: Column, window: Column) -> DataFrame:
    series = [*[c(k) for k in keys], F.col("sensor")]
    constant = F.coalesce((F.col("std") < tolerance) & F.col("flagged").isNull(), F.lit(False))
    by_day = Window.partitionBy(*series).orderBy("day")
    days = days.withColumn("_constant", constant)
    # a run is the stretch of constant days after the same number of other days
    days = days.withColumn("_run", F.count_if(~F.col("_constant")).over(by_day.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(*series, "_run", "_constant")
    place = F.row_number().over(run.orderBy("day"))
    length = F.count("*").over(run)
    return days.withColumn("_place", place).withColumn("_length", length).withColumn(
        "flagged",
        F.when(
            F.col("_constant") & (F.col("_place") <= F.col("_length") - F.pmod(F.col("_length"), window)), F.lit(turn)
        ).otherwise(F.col("flagged")),
    ).drop("_constant", "_run", "_place", "_length")


def constant_stats(flagged: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per key, sensor and category: rows on flagged days (missing readings included) and the days."""
    return flagged.groupBy(*[c(k) for k in keys], "sensor", "category", "window_days", "tolerance").agg(
        F.sum("rows").alias("flagged_count"),
        F.sort_array(F.collect_set(F.col("day").cast("string"))).alias("dates"),
    )


def constant_mask(df: DataFrame, flagged: DataFrame, time_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """NULL out the flagged sensors on the flagged days.

    The flagged days are written out first: the join is a broadcast only if those files are small,
    and otherwise a shuffle join on (keys, day), which AQE splits where a day is hot.
    """
    per_day = materialize(
        flagged.groupBy(*[c(k).alias(f"_k_{k}") for k in keys], F.col("day").alias("_k_day")).agg(
            F.collect_set("sensor").alias("_stuck")
        ),
        "constant-days",
    )
    on = F.to_date(c(time_col)) == F.col("_k_day")
    for k in keys:
        on = on & c(k).eqNullSafe(c(f"_k_{k}"))
    names = sensor_columns(df, [time_col, *keys])
    stuck = lambda n: F.coalesce(F.array_contains("_stuck", n), F.lit(False))
    return df.join(per_day, on, "left").select(
        *[F.when(~stuck(n), c(n)).alias(n) if n in names else c(n) for n in df.columns]
    )
