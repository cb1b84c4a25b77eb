import random
from datetime import timedelta

import pandas as pd
import pytest

from helpers import at, frame, same
from stationloom.errors import ValidationError
from stationloom.operators.interpolate import interpolate, interpolate_by_rules, interpolation_stats
from stationloom.rules import GapRule, GapRules

T = "DateTime timestamp_ntz"
CASE = [None, None, None, 1.0, None, None, None, None, None, None, 8.0, None, None, None]


def series(spark, values, step=3600):
    return frame(spark, [(at("2024-01-01") + timedelta(seconds=step * i), v) for i, v in enumerate(values)], f"{T}, Temp double")


@pytest.mark.parametrize("step", [None, 3600])
@pytest.mark.parametrize("chunk", [None, 3 * 3600])
def test_published_case(spark, step, chunk):
    run = lambda limit: [r.Temp for r in interpolate(series(spark, CASE), ["Temp"], "DateTime", limit=limit, step_seconds=step, chunk_seconds=chunk).orderBy("DateTime").collect()]
    assert run(2) == [None, 1, 1, 1, 2, 3, None, None, 6, 7, 8, 8, 8, None]
    assert run(None) == [1, 1, 1, 1, 2, 3, 4, 5, 6, 7, 8, 8, 8, 8]


@pytest.mark.parametrize("limit", [None, 1, 2, 60])
@pytest.mark.parametrize("regular", [True, False])
def test_equals_pandas(spark, limit, regular):
    rng = random.Random(limit)
    data, want = [], {}
    for s in ("a", "b", "empty"):
        times = [at("2024-01-01") + timedelta(hours=i if regular else i + rng.random() / 2) for i in range(150)]
        cols = [[None if s == "empty" or rng.random() < p else rng.random() for _ in times] for p in (0.5, 0.95)]
        data += list(zip([s] * len(times), times, *cols))
        want[s] = [pd.Series(v, dtype=float).interpolate("linear", limit=limit, limit_direction="both").tolist() for v in cols]
    rng.shuffle(data)
    df = frame(spark, data, f"station string, {T}, x double, y double")
    out = interpolate(df, ["x", "y"], "DateTime", ["station"], limit, 3600 if regular else None, 20 * 3600)
    raw = {(s, t): (x, y) for s, t, x, y in data}
    for s in want:
        got = out.where(f"station = '{s}'").orderBy("DateTime").collect()
        for k, n in enumerate("xy"):
            assert all(same(r[n], w) for r, w in zip(got, want[s][k])), (s, n)
            for r in got:
                assert r[f"{n}_interpolated"] == (raw[s, r.DateTime][k] is None and r[n] is not None)


def test_gap_as_time_and_flags(spark):
    out = interpolate(series(spark, [1.0, None, None, 4.0]), ["Temp"], "DateTime", step_seconds=3600, max_gap_seconds=3600, mark=False)
    assert out.columns == ["DateTime", "Temp"] and [r.Temp for r in out.orderBy("DateTime").collect()] == [1, 2, 3, 4]
    with pytest.raises(ValidationError):
        interpolate(series(spark, [1.0]), ["Temp"], "DateTime", max_gap_seconds=60)


def test_rules_choose_columns(spark):
    df = frame(spark, [(at("2024-01-01"), 1.0, 1.0), (at("2024-01-01 01:00"), None, None), (at("2024-01-01 02:00"), 3.0, 3.0)], f"{T}, Temp_1 double, Met_Speed double")
    rules = GapRules(True, 60, True, (GapRule("temperature", ("Temp",)),))
    out = interpolate_by_rules(df, rules, "DateTime", step_seconds=3600)
    assert out.columns == ["DateTime", "Temp_1", "Met_Speed", "Temp_1_interpolated"]
    assert [tuple(r) for r in interpolation_stats(out, ["Temp_1"]).collect()] == [("Temp_1", 1)]
    assert interpolate_by_rules(df, GapRules(False), "DateTime") is df
    with pytest.raises(ValidationError):
        interpolate_by_rules(df, GapRules(True, 60, True, (GapRule("t", ("Temp",), "cubic"),)), "DateTime")
