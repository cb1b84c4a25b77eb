"""Gap filling along time, also for series of any length.

A window over a whole series would put it into one task. Here a series is cut into time slices:
inside a slice the neighbours of a missing reading come from two ordered windows, and what lies
before and after the slice comes from a table with one row per slice (its first and last known
reading), carried along the series and joined back on the slice. On a regular grid that table is
aggregated from the rows as they lie, and the readings are shuffled once, by (keys, slice).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationloom.columns import c, classify, join_on_keys, nan_to_null, sensor_columns
from stationloom.errors import ValidationError
from stationloom.functions.clock import SECOND, floor_div, micros, time_chunk
from stationloom.rules import GapRules

SUFFIX = "_interpolated"
# A slice of a regular grid holds this many rows.
GRID_ROWS_PER_CHUNK = 4096
# Slice length for rows without a known step; longer slices suit slow sensors.
DEFAULT_CHUNK_SECONDS = 3600


def interpolate(
    df: DataFrame,
    columns: Sequence[str],
    time_col: str,
    keys: Sequence[str] = (),
    limit: int | None = None,
    step_seconds: int | None = None,
    chunk_seconds: int | None = None,
    mark: bool = True,
    max_gap_seconds: int | None = None,
) -> DataFrame:
    """Fill missing readings on the line between their neighbours.

    A reading is filled if its previous or its next known one is at most ``limit`` rows away (no
    limit: always), so a long gap is filled at both ends only. Before the first and after the last
    known reading the nearest one is repeated. ``mark`` adds a boolean ``<column>_interpolated``.

    ``step_seconds`` says that each series is a complete grid of that step (the result of a
    resampling); positions are then computed instead of counted. ``max_gap_seconds`` states the
    limit as a time and needs the step.

    ``df`` is read twice, once for the table of slices; hand in a stored table if it is costly to
    compute.
    """
    if not columns:
        return df
    if max_gap_seconds is not None:
        if not step_seconds:
            raise ValidationError("max_gap_seconds needs step_seconds")
        limit = max_gap_seconds // step_seconds
    limit = limit or None
    width = chunk_seconds or (step_seconds * GRID_ROWS_PER_CHUNK if step_seconds else DEFAULT_CHUNK_SECONDS)

    df = nan_to_null(df)
    ts = c(time_col)
    key_cols = [c(k) for k in keys]
    base = df.withColumn("_chunk", F.coalesce(time_chunk(ts, width), F.lit(-(2**62)).cast("long")))
    if step_seconds:
        base = base.withColumn("_pos", floor_div(micros(ts), step_seconds * SECOND))
        # from the rows as they lie, so that each task hands on one row per slice
        carried = _carry_between_slices(base, columns, keys, counted=False)
    # explicit, as rows that arrive partitioned by the keys alone would stay so, one task per series
    base = base.repartition(*key_cols, F.col("_chunk"))
    slice_ = Window.partitionBy(*key_cols, "_chunk")
    if not step_seconds:
        base = base.withColumn("_pos", F.row_number().over(slice_.orderBy(ts)).cast("long"))
        carried = _carry_between_slices(base, columns, keys, counted=True)
    # counted positions follow the time; ordering by it again reuses the sort they were counted in
    up = slice_.orderBy(F.col("_pos") if step_seconds else ts).rowsBetween(Window.unboundedPreceding, 0)
    down = slice_.orderBy(F.col("_pos").desc()).rowsBetween(Window.unboundedPreceding, 0)
    local = base.select(
        "*",
        *[
            F.last(value, ignorenulls=True).over(frame).alias(f"_{side}{what}{i}")
            for side, frame in (("p", up), ("n", down))
            for i, n in enumerate(columns)
            for what, value in (("v", c(n)), ("p", F.when(c(n).isNotNull(), F.col("_pos"))))
        ],
    )
    offset = F.coalesce(F.col("_offset"), F.lit(0).cast("long"))
    # nearest known reading on either side: in the slice, else what was carried to it
    joined = join_on_keys(local, carried, [*keys, "_chunk"], "left").select(
        *[c(n) for n in df.columns],
        (offset + F.col("_pos")).alias("_pos"),
        *[F.coalesce(f"_{side}v{i}", f"_c{side}v{i}").alias(f"_{side}v{i}") for side in "pn" for i in range(len(columns))],
        *[
            F.coalesce(offset + F.col(f"_{side}p{i}"), F.col(f"_c{side}p{i}")).alias(f"_{side}p{i}")
            for side in "pn"
            for i in range(len(columns))
        ],
    )

    filled: dict[str, Column] = {}
    for i, n in enumerate(columns):
        pos, pv, pp, nv, np_ = (F.col(x) for x in ("_pos", f"_pv{i}", f"_pp{i}", f"_nv{i}", f"_np{i}"))
        line = pv + (nv - pv) * (pos - pp) / (np_ - pp)
        estimate = F.coalesce(line, pv, nv)
        if limit is not None:
            near = F.coalesce(pos - pp <= limit, F.lit(False)) | F.coalesce(np_ - pos <= limit, F.lit(False))
            estimate = F.when(near, estimate)
        filled[n] = F.when(c(n).isNotNull(), c(n)).otherwise(estimate)
    result = joined.select(
        *[filled[n].alias(n) if n in filled else c(n) for n in df.columns],
        *([c(n).isNull().alias(f"_was_null_{i}") for i, n in enumerate(columns)] if mark else []),
    )
    if not mark:
        return result
    return result.select(
        *[c(n) for n in df.columns],
        *[(F.col(f"_was_null_{i}") & c(n).isNotNull()).alias(n + SUFFIX) for i, n in enumerate(columns)],
    )


def _carry_between_slices(base: DataFrame, columns: Sequence[str], keys: Sequence[str], counted: bool) -> DataFrame:
    """Per slice: rows before it in the series, and the known reading nearest to it on either side."""
    pos = F.col("_pos")
    known = lambda n: F.when(c(n).isNotNull(), pos)
    slices = base.groupBy(*[c(k) for k in keys], "_chunk").agg(
        F.count("*").alias("_rows"),
        *[
            m.alias(f"_{kind}{i}")
            for i, n in enumerate(columns)
            for kind, m in (
                ("fp", F.min(known(n))),
                ("fv", F.min_by(c(n), known(n))),
                ("lp", F.max(known(n))),
                ("lv", F.max_by(c(n), known(n))),
            )
        ],
    )
    series = Window.partitionBy(*[c(k) for k in keys])
    earlier = series.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    later = series.orderBy(F.col("_chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    slices = slices.withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), zero) if counted else zero)

    last = lambda value, frame, name: F.last(value, ignorenulls=True).over(frame).alias(name)
    return slices.select(
        *[c(k) for k in keys], "_chunk", "_offset",
        *[
            last(value, frame, f"_c{side}{what}{i}")
            for side, kind, frame in (("p", "l", earlier), ("n", "f", later))
            for i in range(len(columns))
            for what, value in (("v", F.col(f"_{kind}v{i}")), ("p", F.col("_offset") + F.col(f"_{kind}p{i}")))
        ],
    )


def interpolate_by_rules(
    df: DataFrame,
    rules: GapRules,
    time_col: str,
    keys: Sequence[str] = (),
    step_seconds: int | None = None,
) -> DataFrame:
    """Fill the columns that an enabled rule is for."""
    if not rules.enabled:
        return df
    columns = ruled_columns(df, rules, time_col, keys)
    return interpolate(df, list(columns), time_col, keys, rules.limit_rows, step_seconds, mark=rules.mark)


def ruled_columns(df: DataFrame, rules: GapRules, time_col: str, keys: Sequence[str] = ()) -> dict[str, str]:
    """Column to the data type of the first rule for it."""
    patterns = {r.data_type: r.patterns for r in rules.rules}
    unsupported = {r.method for r in rules.rules} - {"linear"}
    if unsupported:
        raise ValidationError(f"only linear interpolation is available, not {sorted(unsupported)}")
    kinds = {n: classify(n, patterns) for n in sensor_columns(df, [time_col, *keys])}
    return {n: k for n, k in kinds.items() if k is not None}


def interpolation_stats(filled: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Filled readings per key and column, from the flag columns."""
    counts = filled.groupBy(*[c(k) for k in keys]).agg(
        *[F.count_if(c(n + SUFFIX)).alias(f"_f{i}") for i, n in enumerate(columns)]
    )
    entries = F.array(
        *[F.struct(F.lit(n).alias("sensor"), F.col(f"_f{i}").alias("filled")) for i, n in enumerate(columns)]
    )
    return counts.select(*[c(k) for k in keys], F.inline(entries))
