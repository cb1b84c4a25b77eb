"""Row-wise masks: readings outside a range or inside a failure window become NULL.

Each mask is a projection, for failure windows after a join with the rule table, whose size Catalyst
knows, and a binary search in the windows of a station. Chained masks stay one stage in the plan. NaN counts as missing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationloom.columns import (
    QC_TIME_NAMES,
    c,
    join_on_keys,
    nan_to_null,
    sensor_columns,
    time_column,
    unpivot_stats,
)
from stationloom.errors import ValidationError
from stationloom.functions.clock import DAY, hour_in, micros
from stationloom.rules import FailureWindow, RangeRule
from stationloom.storage import local_table, materialize


def _rule_of(name: str, rules: Sequence[RangeRule]) -> RangeRule | None:
    return next((r for r in rules if any(p in name for p in r.patterns)), None)


def _ruled(df: DataFrame, rules: Sequence[RangeRule], exclude: Sequence[str]) -> dict[str, RangeRule]:
    found = {n: _rule_of(n, rules) for n in sensor_columns(df, exclude)}
    return {n: r for n, r in found.items() if r is not None}


def _outside(v: Column, rule: RangeRule) -> Column:
    """Both bounds themselves are outside."""
    return (v <= rule.lower) | (v >= rule.upper)


def _day_night_flags(v: Column, rule: RangeRule, ts: Column) -> tuple[Column, Column]:
    """(out of bounds by day, out of bounds by night); lower bounds themselves are inside."""
    d = rule.day_night
    day = hour_in(ts, d.start_hour, d.end_hour)
    night_upper = rule.upper if d.night_upper is None else d.night_upper
    return (
        day & ((v < d.day_lower) | (v >= rule.upper)),
        ~day & ((v < d.night_lower) | (v >= night_upper)),
    )


def _flag(v: Column, rule: RangeRule, ts: Column | None, prefilter: bool) -> Column:
    if rule.day_night is None or ts is None:
        return _outside(v, rule)
    by_day, by_night = _day_night_flags(v, rule, ts)
    timed = by_day | by_night
    return (_outside(v, rule) | timed) if prefilter else timed


def range_mask(
    df: DataFrame,
    rules: Sequence[RangeRule],
    time_col: str | None = None,
    exclude: Sequence[str] = (),
    prefilter: bool = True,
) -> DataFrame:
    """NULL out readings outside the range of the first rule whose pattern is part of the column name.

    A rule with day and night bounds first applies its overall range, bounds included, so zeros
    are masked at night too; ``prefilter=False`` leaves only the day and night bounds.
    """
    time_col = time_col or time_column(df.columns, reversed(QC_TIME_NAMES))
    df = nan_to_null(df)
    ts = c(time_col) if time_col else None
    ruled = _ruled(df, rules, [*exclude, *([time_col] if time_col else [])])
    return df.select(
        *[
            F.when(~_flag(c(n), ruled[n], ts, prefilter), c(n)).alias(n) if n in ruled else c(n)
            for n in df.columns
        ]
    )


def _percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


@dataclass(frozen=True)
class Counts:
    """Aggregates of a statistic and how its rows are read off them; several share one pass over a table."""

    measures: list[Column]
    entries: list[dict[str, Column]]
    listed: str

    def read(self, counted: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
        stats = unpivot_stats(counted, keys, self.entries).where(self.listed)
        return stats.drop(*[n for n in stats.columns if n.startswith("_")])


def range_counts(
    df: DataFrame,
    rules: Sequence[RangeRule],
    time_col: str | None = None,
    exclude: Sequence[str] = (),
    prefilter: bool = True,
) -> Counts:
    """Aggregates for the statistics of a table without NaN."""
    time_col = time_col or time_column(df.columns, reversed(QC_TIME_NAMES))
    ts = c(time_col) if time_col else None
    ruled = _ruled(df, rules, [*exclude, *([time_col] if time_col else [])])
    if not ruled:
        raise ValidationError("no column is covered by a range rule")
    measures: list[Column] = []
    entries = []
    for i, (name, rule) in enumerate(ruled.items()):
        v = c(name)
        timed = rule.day_night is not None and ts is not None
        kept = F.when(~_outside(v, rule), v) if timed and prefilter else v
        by_day, by_night = _day_night_flags(kept, rule, ts) if timed else (F.lit(False), F.lit(False))
        flagged = (by_day | by_night) if timed else _outside(v, rule)
        measures += [
            F.count(kept).alias(f"initial_{i}"),
            F.count_if(flagged).alias(f"flagged_{i}"),
            F.count_if(by_day).alias(f"day_{i}"),
            F.count_if(by_night).alias(f"night_{i}"),
            (F.count_if(_outside(v, rule)) if timed and prefilter else F.lit(0).cast("long")).alias(f"pre_{i}"),
        ]
        initial, n, day, night = (c(f"{k}_{i}") for k in ("initial", "flagged", "day", "night"))
        none, long_none = F.lit(None).cast("double"), F.lit(None).cast("long")
        entries.append(
            {
                "sensor": F.lit(name),
                "variable_type": F.lit(rule.variable),
                "initial_count": initial,
                "flagged_count": n,
                "flagged_percentage": _percent(n, initial),
                "bounds": F.lit(rule.bounds_text if timed else rule.plain_bounds_text),
                "daytime_flagged": day if timed else long_none,
                "nighttime_flagged": night if timed else long_none,
                "daytime_percentage": _percent(day, initial) if timed else none,
                "nighttime_percentage": _percent(night, initial) if timed else none,
                "prefiltered_count": c(f"pre_{i}"),
                "_always": F.lit(rule.day_night is not None),
            }
        )
    return Counts(measures, entries, "_always OR flagged_count > 0")


def range_stats(
    df: DataFrame,
    rules: Sequence[RangeRule],
    time_col: str | None = None,
    keys: Sequence[str] = (),
    exclude: Sequence[str] = (),
    prefilter: bool = True,
) -> DataFrame:
    """What :func:`range_mask` flags, one row per key and ruled column.

    Columns without day and night bounds appear only if something was flagged. For the others the
    counts are those of the day and night pass; ``prefiltered_count`` is what the overall range
    took out before it.
    """
    df = nan_to_null(df)
    counts = range_counts(df, rules, time_col, [*exclude, *keys], prefilter)
    return counts.read(df.groupBy(*[c(k) for k in keys]).agg(*counts.measures), keys)


def _affected(columns: Sequence[str], w: FailureWindow) -> list[str]:
    """Columns by pattern; one that fits two patterns is listed twice."""
    return [n for p in w.sensors for n in columns if p in n]


def _spans(spark: SparkSession, windows: Sequence[FailureWindow], whole_last_day: bool) -> list[tuple[int, int]]:
    """First and last microsecond of each window; bounds are read as Spark reads them, from a table that needs no job."""
    given = local_table(spark, [(i, w.start, w.end) for i, w in enumerate(windows)], "i int, first string, last string")
    at = lambda n: micros(F.col(n).cast("timestamp_ntz"))
    rows = given.select("i", at("first").alias("first"), (at("last") + (DAY - 1 if whole_last_day else 0)).alias("last")).collect()
    found = {r["i"]: (r["first"], r["last"]) for r in rows}
    return [found[i] for i in range(len(windows))]


def _merged(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same moments as disjoint spans in order."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(s for s in spans if s[0] <= s[1]):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def _count_upto(points: Column, value: Column, most: int) -> Column:
    """How many of the sorted ``points``, ``most`` at the most, are not above ``value``: a binary search; 0 for NULL."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(most, 1).bit_length()))])
    return F.aggregate(
        steps, F.lit(0), lambda found, step: F.when(F.get(points, found + step - 1) <= value, found + step).otherwise(found)
    )


def failure_mask(
    df: DataFrame,
    windows: Sequence[FailureWindow],
    station: Column,
    time_col: str,
    exclude: Sequence[str] = (),
    whole_last_day: bool = False,
) -> DataFrame:
    """NULL out the listed sensors of a station from ``start`` to ``end``.

    Bounds are midnights, both included, so the last day loses only its 00:00:00 row unless
    ``whole_last_day``. ``station`` is the expression that gives a row's station key. The rule table
    has one row per station, joined on it: for each sensor the sorted bounds of its windows, made disjoint. A row is inside
    one if the number of bounds up to its time is odd, which a binary search finds, so its cost hardly depends on how
    many windows a station has.
    """
    sensors = sensor_columns(df, [*exclude, time_col])
    spans = _spans(df.sparkSession, windows, whole_last_day)
    by_station: dict[str, dict[str, list]] = {}
    for w, span in zip(windows, spans):
        for n in dict.fromkeys(_affected(sensors, w)):
            by_station.setdefault(w.station, {}).setdefault(n, []).append(span)
    failing = [n for n in sensors if any(n in found for found in by_station.values())]
    if not failing:
        return df
    bounds = {
        s: {n: [x for first, last in _merged(each) for x in (first, last + 1)] for n, each in found.items()}
        for s, found in by_station.items()
    }
    schema = ", ".join(["_station string", *[f"_bounds_{i} array<long>" for i in range(len(failing))]])
    table = local_table(df.sparkSession, [(s, *[found.get(n) for n in failing]) for s, found in bounds.items()], schema)
    joined = df.withColumn("_key", station).join(table, F.col("_key") == F.col("_station"), "left")
    at = micros(c(time_col).cast("timestamp_ntz"))

    def hit(i: int, n: str) -> Column:
        most = max(len(found.get(n, ())) for found in bounds.values())
        return _count_upto(F.col(f"_bounds_{i}"), at, most) % 2 == 1

    hits = {n: hit(i, n) for i, n in enumerate(failing)}
    return joined.select(*[F.when(~hits[n], c(n)).alias(n) if n in hits else c(n) for n in df.columns])


def failure_stats(
    df: DataFrame,
    windows: Sequence[FailureWindow],
    station: Column,
    time_col: str,
    exclude: Sequence[str] = (),
    whole_last_day: bool = False,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Rows per key and window, with the columns and patterns it concerns.

    A key has a row for each window of the stations it has rows of; ``failure_station`` is the
    station of the rule. The bounds of a station's windows cut time into stretches; rows are counted by the stretch that a
    binary search finds, and a window's rows are a difference of running sums over stretches. Only counts are shuffled.
    """
    sensors = sensor_columns(df, [*exclude, *keys, time_col])
    useful = [w for w in windows if _affected(sensors, w)]
    if not useful:
        raise ValidationError("no failure window concerns a column of this table")
    spark, key_cols = df.sparkSession, [c(k) for k in keys]
    spans = _spans(spark, useful, whole_last_day)
    points: dict[str, list[int]] = {}
    for w, (first, last) in zip(useful, spans):
        points.setdefault(w.station, []).extend([first, max(first, last + 1)])
    points = {s: sorted(set(p)) for s, p in points.items()}
    place = {s: {x: i + 1 for i, x in enumerate(p)} for s, p in points.items()}
    listed = [
        (i, w.station, _affected(sensors, w), f"{w.start} to {w.end}", list(w.sensors),
         place[w.station][first], place[w.station][max(first, last + 1)])
        for i, (w, (first, last)) in enumerate(zip(useful, spans))
    ]
    schema = (
        "_rule int, failure_station string, affected_columns array<string>, failure_period string, "
        "sensor_patterns array<string>, _from int, _to int"
    )
    described = local_table(spark, listed, schema)
    table = local_table(spark, list(points.items()), "failure_station string, _points array<long>")
    most = max(map(len, points.values()))
    rows = df.select(*key_cols, station.alias("_key"), micros(c(time_col).cast("timestamp_ntz")).alias("_ts"))
    rows = rows.join(table, F.col("_key") == F.col("failure_station"))
    stretch = _count_upto(F.col("_points"), F.col("_ts"), most).alias("_at")
    counted = materialize(rows.groupBy(*key_cols, "failure_station", stretch).agg(F.count("*").alias("_n")), "failure-counts")
    present = counted.select(*key_cols, "failure_station").distinct().join(described, "failure_station")
    # what lies before each bound of a window: its rows come before the stretch that starts there
    sides = F.inline(F.array(*[F.struct(F.col(n).alias("_at"), F.lit(sign).alias("_sign")) for n, sign in (("_from", -1), ("_to", 1))]))
    bounds = present.select(*key_cols, "failure_station", "_rule", sides)
    here = counted.select(*key_cols, "failure_station", F.lit(None).cast("int").alias("_rule"), "_at", F.lit(0).alias("_sign"), "_n")
    every = here.unionByName(bounds.withColumn("_n", F.lit(0).cast("long")))
    order = Window.partitionBy(*key_cols, "failure_station").orderBy("_at", F.col("_rule").asc_nulls_last())
    before = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hits = every.select(*key_cols, "_rule", (before * F.col("_sign")).alias("_hits")).where("_rule IS NOT NULL")
    hits = hits.groupBy(*key_cols, "_rule").agg(F.sum("_hits").alias("_hits"))
    found = join_on_keys(present, hits, [*keys, "_rule"], "left")
    return found.select(
        *key_cols, "failure_station", "affected_columns", "failure_period",
        F.coalesce("_hits", F.lit(0).cast("long")).alias("affected_timestamps"), "sensor_patterns",
    )
