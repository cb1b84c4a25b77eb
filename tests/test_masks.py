from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import at, frame, rows
from stationloom.columns import c, classify, matching, nan_to_null, time_column
from stationloom.errors import ValidationError
from stationloom.operators.masks import failure_mask, failure_stats, range_mask, range_stats
from stationloom.rules import DayNight, FailureWindow, RangeRule

T = "DateTime timestamp_ntz"


def test_range_bounds_are_outside(spark):
    df = frame(spark, [(at("2024-01-01"), v, v) for v in (-1.0, 0.0, 0.5, 100.0, 101.0, None)], f"{T}, `Humi_1 []` double, other double")
    out = range_mask(df, [RangeRule("rh", 0, 100, ("Humi",))])
    assert [r["Humi_1 []"] for r in out.collect()] == [None, None, 0.5, None, None, None]
    assert [r["other"] for r in out.collect()] == [-1.0, 0.0, 0.5, 100.0, 101.0, None]


def test_first_rule_wins_and_case_matters():
    rules = {"a": ("Temp",), "b": ("TC_Temp",)}
    assert classify("TC_Temp1", rules) == "a"
    assert classify("temp", rules) is None
    assert matching(["x", "aTCb"], ["TC"]) == ["aTCb"]
    assert time_column(["Time", "v"], ("DateTime", "Time"), "v") == "Time"


def test_nan_is_null(spark):
    df = frame(spark, [(float("nan"), 1), (2.0, 2)], "`a.b` double, k int")
    assert rows(nan_to_null(df), "k") == [(None, 1), (2.0, 2)]


def test_day_and_night(spark):
    rule = RangeRule("pv", 0, 1000, ("P",), "W", day_night=DayNight(7, 17, 1, 0))
    times = ["06:59", "07:00", "16:59", "17:00"]
    df = frame(spark, [(at(f"2024-01-01 {t}"), v) for t in times for v in (0.0, 0.5, 1.0, 1000.0)], f"{T}, P double")
    kept = lambda d: sorted((r[0].strftime("%H:%M"), r[1]) for r in d.collect() if r[1] is not None)
    assert kept(range_mask(df, [rule])) == [("06:59", 0.5), ("06:59", 1.0), ("07:00", 1.0), ("16:59", 1.0), ("17:00", 0.5), ("17:00", 1.0)]
    # without the overall range first, zeros at night are fine
    assert ("06:59", 0.0) in kept(range_mask(df, [rule], prefilter=False))
    s = range_stats(df, [rule]).first()
    assert (s.initial_count, s.flagged_count, s.daytime_flagged, s.nighttime_flagged, s.prefiltered_count) == (8, 2, 2, 0, 8)
    assert s.flagged_percentage == 25.0
    assert s.bounds == "Daytime (07:00-17:00): 1 to 1000 W, Nighttime: 0 to 1000 W"


def test_no_time_column_uses_the_overall_range(spark):
    rule = RangeRule("pv", 0, 1000, ("P",), "W", day_night=DayNight(7, 17, 1, 0))
    df = frame(spark, [(0.0,), (0.5,)], "P double")
    assert [r.P for r in range_mask(df, [rule]).collect()] == [None, 0.5]
    s = range_stats(df, [rule]).first()
    assert (s.initial_count, s.flagged_count, s.daytime_flagged) == (2, 1, None)


def test_stats_only_for_flagged(spark):
    df = frame(spark, [("s", 1.0, 5.0), ("s", 2.0, None)], "station string, a1 double, b1 double")
    rules = [RangeRule("a", 0, 10, ("a1",)), RangeRule("b", 0, 5, ("b1",))]
    assert [r.sensor for r in range_stats(df, rules, keys=["station"]).collect()] == ["b1"]
    with pytest.raises(ValidationError):
        range_stats(df, [RangeRule("z", 0, 1, ("zzz",))], keys=["station"])


def test_failure_window_ends_at_midnight(spark):
    df = frame(spark, [("x", at(t), 1.0, 1.0) for t in ("2024-10-15 23:00", "2024-10-16 00:00", "2024-10-16 00:05")] + [("y", at("2024-10-15"), 1.0, 1.0)],
               f"station string, {T}, Humi_1 double, Rad double")
    w = [FailureWindow("x", "2024-10-01", "2024-10-16", ("Humi_",))]
    out = rows(failure_mask(df, w, c("station"), "DateTime", ["station"]), "station", "DateTime")
    assert [r[2] for r in out] == [None, None, 1.0, 1.0] and [r[3] for r in out] == [1.0] * 4
    whole = rows(failure_mask(df, w, c("station"), "DateTime", ["station"], whole_last_day=True), "station", "DateTime")
    assert [r[2] for r in whole] == [None, None, None, 1.0]
    s = failure_stats(df, w, c("station"), "DateTime", ["station"]).first()
    assert (s.affected_timestamps, s.affected_columns, s.failure_period) == (2, ["Humi_1"], "2024-10-01 to 2024-10-16")


@pytest.mark.parametrize("whole_last_day", [False, True])
@pytest.mark.parametrize("n", [1, 64, 65, 1000])
def test_any_number_of_failure_windows(spark, whole_last_day, n):
    day = timedelta(days=1)
    windows = [
        FailureWindow(f"s{i % 5}", f"{at('2024-01-01') + i // 5 * day:%Y-%m-%d}", f"{at('2024-01-02') + i // 5 * day:%Y-%m-%d}", ("a",) if i % 2 else ("b", "a"))
        for i in range(0, 3 * n, 3)
    ]
    data = [(f"k{k % 2}" if k % 7 else None, f"s{k % 6}", at("2024-01-01") + timedelta(hours=5 * k), 1.0, 2.0, 3.0) for k in range(120)]
    df = frame(spark, data, f"key string, station string, {T}, a double, b double, c double")
    hit = lambda w, r: r[1] == w.station and at(w.start) <= r[2] and (r[2] < at(w.end) + day if whole_last_day else r[2] <= at(w.end))
    failed = lambda r, s: any(s in w.sensors and hit(w, r) for w in windows)
    want = sorted((r[2], None if failed(r, "a") else 1.0, None if failed(r, "b") else 2.0, 3.0) for r in data)
    masked = failure_mask(df, windows, c("station"), "DateTime", ["key", "station"], whole_last_day)
    assert rows(masked.select("DateTime", "a", "b", "c"), "DateTime") == want
    stats = failure_stats(df, windows, c("station"), "DateTime", ["station"], whole_last_day, ["key"])
    assert stats.columns == ["key", "failure_station", "affected_columns", "failure_period", "affected_timestamps", "sensor_patterns"]
    got = sorted((r.key or "", r.failure_station, r.failure_period, r.affected_timestamps) for r in stats.collect())
    keys = {(r[0], r[1]) for r in data}
    assert got == sorted(
        (k or "", s, f"{w.start} to {w.end}", sum(hit(w, r) for r in data if r[0] == k)) for k, s in keys for w in windows if w.station == s
    )


def test_nan_is_missing(spark):
    df = frame(spark, [("x", at("2024-01-01"), float("nan")), ("x", at("2024-01-02"), 99.0)], f"station string, {T}, Temp double")
    rules = [RangeRule("t", 0, 60, ("Temp",))]
    assert range_stats(df, rules, keys=["station"]).first().initial_count == 1
    assert [r[2] for r in rows(range_mask(df, rules, exclude=["station"]), "DateTime")] == [None, None]


def test_masks_do_not_shuffle_the_readings(spark):
    df = frame(spark, [("s", at("2024-01-01"), 1.0)], f"station string, {T}, Temp_1 double")
    windows = [FailureWindow("s", "2024-01-01", "2024-01-02", ("Temp",))]
    masked = range_mask(failure_mask(df, windows, c("station"), "DateTime", ["station"]), [RangeRule("t", 0, 60, ("Temp",))], exclude=["station"])
    assert masked.collect()[0].Temp_1 is None
    plan = masked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_very_many_windows_on_one_station(spark):
    start = at("2020-01-01")
    days = [start + timedelta(days=2 * i) for i in range(10_000)]
    # every other day, some of them overlapping or empty, one with hours
    windows = [FailureWindow("s", f"{d:%Y-%m-%d}", f"{d + timedelta(days=i % 3 == 0):%Y-%m-%d}", ("v",)) for i, d in enumerate(days)]
    windows += [FailureWindow("s", "2021-05-05 06:00:00", "2021-05-05 07:30:00", ("w",)), FailureWindow("s", "2021-05-07", "2021-05-01", ("w",))]
    windows += [FailureWindow("t", "2020-01-01", "2030-01-01", ("v",))]
    data = [("s", start + timedelta(hours=h), 1.0, 1.0) for h in range(0, 24 * 600, 5)] + [("s", None, 1.0, 1.0), ("t", start, 1.0, 1.0), (None, start, 1.0, 1.0)]
    df = frame(spark, data, "station string, DateTime timestamp_ntz, v double, w double")

    def inside(w, s, t, whole):
        from datetime import datetime

        first, last = datetime.fromisoformat(w.start), datetime.fromisoformat(w.end)
        return w.station == s and t is not None and first <= t <= last + timedelta(days=whole, microseconds=-whole)

    by_day = {}
    for w in windows:
        by_day.setdefault(w.station, []).append(w)
    for whole in (False, True):
        out = failure_mask(df, windows, F.col("station"), "DateTime", ["station"], whole)
        near = lambda s, t: [w for w in by_day.get(s, ()) if t is None or len(w.start) > 10 or s == "t" or w.start > w.end or abs((at(w.start + " 00:00") - t).days) < 4]
        want = [
            (s, t, *[None if any(n in w.sensors and inside(w, s, t, whole) for w in near(s, t)) else 1.0 for n in "vw"]) for s, t, _, _ in data
        ]
        assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
        stats = failure_stats(df, windows, F.col("station"), "DateTime", ["station"], whole)
        found = {(r.failure_station, r.failure_period): r.affected_timestamps for r in stats.collect()}
        assert len(found) == len(windows)
        for w in [*windows[:250:7], *windows[-3:]]:
            assert found[w.station, f"{w.start} to {w.end}"] == sum(inside(w, s, t, whole) for s, t, _, _ in data)
