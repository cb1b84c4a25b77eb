"""Time differences along a series and exact medians, without putting a series into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationloom.columns import c, join_on_keys
from stationloom.functions.clock import SECOND, micros, time_chunk
from stationloom.storage import materialize

DEFAULT_CHUNK_SECONDS = 3600
NO_TIME_PARTS = 4096


def _in_slices(
    df: DataFrame, time_col: str, keys: Sequence[str], chunk_seconds: int, unique_times: bool
) -> DataFrame:
    """``(keys, _chunk, time, copies, _before, _after)``: distinct times with their neighbours in their time slice.

    Copies of a time are counted before any shuffle by slice, so a time that very many rows share is one row;
    ``unique_times`` says that there are none (a table after a keep-first step) and saves that. Rows without a time are one
    more, in a slice of their own.
    """
    key_cols = [c(k) for k in keys]
    rows = df.select(*key_cols, c(time_col).alias("time"))
    chunk = time_chunk(F.col("time"), chunk_seconds)
    if unique_times:
        # but any number of rows may have no time: they are counted in many parts
        part = F.pmod(F.monotonically_increasing_id(), F.lit(NO_TIME_PARTS)) - (1 << 62)
        times = rows.withColumn("copies", F.lit(1).cast("long")).withColumn("_chunk", F.coalesce(chunk, part))
    else:
        times = rows.groupBy(*key_cols, "time").agg(F.count("*").alias("copies")).withColumn("_chunk", chunk)
    inside = Window.partitionBy(*key_cols, "_chunk").orderBy("time")
    return times.select("*", F.lag("time").over(inside).alias("_before"), F.lead("time").over(inside).alias("_after"))


def _step(before: Column, after: Column) -> Column:
    return micros(after) - micros(before)


def slice_summaries(
    df: DataFrame, time_col: str, keys: Sequence[str] = (), chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
    unique_times: bool = False,
) -> DataFrame:
    """``(keys, _chunk, step_micros, n, first, last)``: the histogram of steps inside each time slice, stored.

    The first time of a slice has no step in it, copies of a time have steps of nothing, and rows without a time have
    neither step nor ``first`` and ``last``. Summaries merge: counts add up, and the step between two slices that follow each other comes from
    the last time of one and the first of the other. Regular slices are two rows.
    """
    key_cols = [c(k) for k in keys]
    counted = F.inline(
        F.array(
            F.struct(_step(F.col("_before"), F.col("time")).alias("step_micros"), F.when(F.col("time").isNull(), F.col("copies")).otherwise(1).alias("n")),
            F.struct(F.lit(0).cast("long").alias("step_micros"), F.when(F.col("time").isNotNull(), F.col("copies") - 1).alias("n")),
        )
    )
    steps = _in_slices(df, time_col, keys, chunk_seconds, unique_times).select(*key_cols, "_chunk", "time", counted)
    summaries = steps.where("n > 0").groupBy(*key_cols, "_chunk", "step_micros").agg(
        F.sum("n").alias("n"), F.min("time").alias("first"), F.max("time").alias("last")
    )
    return materialize(summaries, "slice-summaries")


def step_histogram(summaries: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, step_micros, n)`` of whole series, steps between slices included."""
    key_cols = [c(k) for k in keys]
    slices = summaries.where("first IS NOT NULL").groupBy(*key_cols, "_chunk").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    before = F.lag("last").over(Window.partitionBy(*key_cols).orderBy("_chunk"))
    border = slices.select(*key_cols, _step(before, F.col("first")).alias("step_micros"), F.lit(1).cast("long").alias("n"))
    every = summaries.select(*key_cols, "step_micros", "n").unionByName(border).where("step_micros IS NOT NULL")
    return every.groupBy(*key_cols, "step_micros").agg(F.sum("n").alias("n"))


def temporal_gaps(
    df: DataFrame,
    time_col: str,
    expected_seconds: float,
    keys: Sequence[str] = (),
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
    unique_times: bool = False,
) -> DataFrame:
    """Steps longer than twice the expected one: ``(keys, start, end, duration_s)``.

    Gaps inside time slices come from their rows; between slices they come from the first and last time of each. Both are
    kept in one pass over the table.
    """
    key_cols = [c(k) for k in keys]
    limit = F.lit(int(2 * expected_seconds * SECOND))
    step = _step(F.col("_before"), F.col("time"))
    rows = _in_slices(df, time_col, keys, chunk_seconds, unique_times).where("time IS NOT NULL")
    edges = rows.where((step > limit) | F.col("_before").isNull() | F.col("_after").isNull())
    edges = materialize(edges.select(*key_cols, "_chunk", "time", "_before", "_after"), "slice-edges")
    inside = edges.select(*key_cols, F.col("_before").alias("start"), F.col("time").alias("end"))
    slices = edges.groupBy(*key_cols, "_chunk").agg(F.min("time").alias("end"), F.max("time").alias("_last"))
    start = F.lag("_last").over(Window.partitionBy(*key_cols).orderBy("_chunk")).alias("start")
    found = inside.unionByName(slices.select(*key_cols, start, "end")).withColumn("_step", _step(F.col("start"), F.col("end")))
    return found.where(F.col("_step") > limit).select(*key_cols, "start", "end", (F.col("_step") / F.lit(float(SECOND))).alias("duration_s"))


def temporal_consistency(
    df: DataFrame,
    time_col: str,
    keys: Sequence[str] = (),
    expected_seconds: float | None = None,
    chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
    unique_times: bool = False,
) -> DataFrame:
    """Per key: records, time range, median/min/max interval in seconds and, if a step is expected, gaps.

    One pass over the table reduces it to a summary per time slice; every figure is read off that table.
    """
    key_cols = [c(k) for k in keys]
    summaries = slice_summaries(df, time_col, keys, chunk_seconds, unique_times)
    histogram = materialize(step_histogram(summaries, keys), "step-histogram")
    step = F.col("step_micros")
    limit = F.lit(int(2 * expected_seconds * SECOND)) if expected_seconds else F.lit(None).cast("long")
    figures = histogram.groupBy(*key_cols).agg(
        F.min(step).alias("_min"),
        F.max(step).alias("_max"),
        F.coalesce(F.sum(F.when(step > limit, F.col("n"))), F.lit(0).cast("long")).alias("gap_count"),
        F.coalesce(F.sum(F.when(step < 0, F.col("n"))), F.lit(0).cast("long")).alias("backwards"),
    )
    # rows without a time count as records only
    records = summaries.groupBy(*key_cols).agg(
        F.sum("n").alias("total_records"), F.min("first").alias("start"), F.max("last").alias("end"), F.count("first").alias("_timed")
    )
    median = exact_median(histogram, "step_micros", "n", keys)
    # without keys one row each, put side by side through a constant key
    one = [] if keys else [F.lit(1).alias("_one")]
    on = list(keys) or ["_one"]
    joined = records.select("*", *one)
    for part in (figures, median):
        joined = join_on_keys(joined, part.select("*", *one), on, "left")
    seconds = lambda v: F.col(v) / F.lit(float(SECOND))
    # a series with a single time has no step, one without a time has no figures
    figure = lambda v: F.coalesce(v, F.when(F.col("_timed") > 0, F.lit(0).cast("long"))).alias(v)
    return joined.select(
        *key_cols, F.coalesce("total_records", F.lit(0).cast("long")).alias("total_records"), "start", "end",
        seconds("median").alias("median_interval_s"),
        seconds("_min").alias("min_interval_s"),
        seconds("_max").alias("max_interval_s"),
        *([figure("gap_count")] if expected_seconds else []),
        figure("backwards"),
    )


def exact_median(histogram: DataFrame, value: str, count: str, keys: Sequence[str] = ()) -> DataFrame:
    """Exact median per key of an integer column given as a histogram.

    Found in two steps so that no key has to fit a task: values are counted in classes of nearly
    equal size (1024 to each power of two), the classes of the middle ranks are picked, and only
    their values are ordered.
    """
    key_cols = [c(k) for k in keys]
    rows = histogram.where(c(value).isNotNull()).select(*key_cols, c(value).alias("_v"), c(count).alias("_c"))
    size = F.floor(F.log2(F.abs("_v").cast("double") + 1) * 1024)
    rows = rows.withColumn("_class", F.when(F.col("_v") < 0, -size).otherwise(size))
    by_class = Window.partitionBy(*key_cols).orderBy("_class")
    classes = (
        rows.groupBy(*key_cols, "_class").agg(F.sum("_c").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(by_class.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy(*key_cols)))
        .withColumn("_lo", F.floor((F.col("_total") - 1) / 2))
        .withColumn("_hi", F.floor(F.col("_total") / 2))
        .where("_upto > _lo AND _upto - _n <= _hi")
        .select(*key_cols, "_class", (F.col("_upto") - F.col("_n")).alias("_base"), "_lo", "_hi")
    )
    upto = F.col("_base") + F.sum("_c").over(
        Window.partitionBy(*key_cols, "_class").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = join_on_keys(rows, classes, [*keys, "_class"]).withColumn("_upto", upto)
    below = F.col("_upto") - F.col("_c")
    holds = lambda rank: (F.col("_upto") > F.col(rank)) & (below <= F.col(rank))
    return ranked.groupBy(*key_cols).agg(
        ((F.max(F.when(holds("_lo"), F.col("_v"))) + F.max(F.when(holds("_hi"), F.col("_v")))) / F.lit(2.0)).alias(
            "median"
        )
    )
