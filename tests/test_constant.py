import random
from datetime import timedelta

import pytest

from helpers import at, frame
from stationloom.operators.constant import constant_days, constant_mask, constant_stats, daily_std
from stationloom.rules import ConstantRule

T = "DateTime timestamp_ntz"


def brute_force(days, window):
    """Days flagged when runs of constant days are walked one by one."""
    flagged, streak = [], []
    for day, constant in days:
        streak = [*streak, day] if constant else []
        if len(streak) == window:
            flagged += streak
            streak = []
    return flagged


@pytest.mark.parametrize("window", [1, 3, 7])
def test_runs_against_brute_force(spark, window):
    rng = random.Random(window)
    data, expected = [], {}
    for station in ("a", "b"):
        days = []
        for d in range(80):
            if rng.random() < 0.1:
                continue  # a day without rows does not interrupt a run
            day, constant = at("2024-01-01") + timedelta(days=d), rng.random() < 0.8
            days.append((day.date(), constant))
            data += [(station, day + timedelta(hours=h), 5.0 if constant else float(h)) for h in range(3)]
        expected[station] = brute_force(days, window)
    df = frame(spark, data, f"station string, {T}, Temp_1 double")
    flagged = constant_days(df, [ConstantRule("temperature", ("Temp",), window)], "DateTime", ["station"])
    got = flagged.orderBy("station", "day").collect()
    assert [(r.station, r.day) for r in got] == [(s, d) for s in ("a", "b") for d in expected[s]]
    masked = constant_mask(df, flagged, "DateTime", ["station"]).collect()
    for r in masked:
        assert (r.Temp_1 is None) == (r.DateTime.date() in expected[r.station])
    stats = {r.station: r for r in constant_stats(flagged, ["station"]).collect()}
    for s in expected:
        if expected[s]:
            assert stats[s].flagged_count == 3 * len(expected[s])
            assert stats[s].dates == sorted(str(d) for d in expected[s])


def test_single_reading_is_not_constant(spark):
    df = frame(spark, [(at("2024-01-01"), 1.0), (at("2024-01-02 01:00"), 2.0), (at("2024-01-02 02:00"), 2.0), (None, 2.0)], f"{T}, Temp double")
    assert [r.Temp for r in daily_std(df, "DateTime").orderBy("day").collect()] == [None, 0.0]
    flagged = constant_days(df, [ConstantRule("t", ("Temp",))], "DateTime")
    assert [str(r.day) for r in flagged.collect()] == ["2024-01-02"]
    masked = constant_mask(df, flagged, "DateTime")
    assert sorted((str(r.DateTime), r.Temp) for r in masked.collect() if r.Temp) == [("2024-01-01 00:00:00", 1.0), ("None", 2.0)]


def test_second_category_no_longer_sees_flagged_days(spark):
    # five constant days; the first category takes 3 of them, so two are left for a window of 2
    data = [(at("2024-01-01") + timedelta(days=d, hours=h), 5.0) for d in range(5) for h in range(2)]
    df = frame(spark, data, f"{T}, Met_Temp double")
    rules = [ConstantRule("first", ("Temp",), 3), ConstantRule("second", ("Met_",), 2)]
    got = constant_days(df, rules, "DateTime").orderBy("day").collect()
    assert [(r.day.day, r.category, r.window_days) for r in got] == [(1, "first", 3), (2, "first", 3), (3, "first", 3), (4, "second", 2), (5, "second", 2)]
    only_four = constant_days(df.where("DateTime < '2024-01-05'"), rules, "DateTime").collect()
    assert sorted(r.day.day for r in only_four) == [1, 2, 3]
