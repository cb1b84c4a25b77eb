import random
from datetime import timedelta

import pandas as pd
import pytest

from helpers import at, frame, rows, same
from stationloom.errors import DataProcessingError, ValidationError
from stationloom.functions.frequency import parse_frequency
from stationloom.operators.resample import aggregation_method, resample, resample_stats

T = "DateTime timestamp_ntz"
PANDAS_NAMES = {"M": "ME", "2M": "2ME", "3M": "3ME", "Q": "QE", "Y": "YE"}


def test_hourly_mean_and_sum(spark):
    data = [(at("2024-01-01 00:10"), 1.0), (at("2024-01-01 00:50"), 2.0), (at("2024-01-01 03:00"), 3.0), (None, 9.0)]
    df = frame(spark, data, f"{T}, v double")
    assert [r[1] for r in rows(resample(df, "1h"), "DateTime")] == [1.5, None, None, 3.0]
    assert [r[1] for r in rows(resample(df, "1h", methods={"v": "sum"}), "DateTime")] == [3.0, 0.0, 0.0, 3.0]


def test_circular_mean(spark):
    data = [(at("2024-01-01 00:10"), 350.0, 350.0), (at("2024-01-01 00:20"), 10.0, 10.0), (at("2024-01-01 02:00"), 270.0, 270.0), (at("2024-01-01 02:30"), None, None)]
    out = rows(resample(frame(spark, data, f"{T}, Met_Dir1 double, WindDirection_deg double"), "1h"), "DateTime")
    assert min(out[0][1], 360 - out[0][1]) < 1e-9 and out[0][2] == 180.0
    assert out[1][1] is None and same(out[2][1], 270.0)


@pytest.mark.parametrize("frequency", ["30min", "1h", "7h", "1D", "2D", "W", "2W", "M", "2M", "3M", "Q", "Y", "MS", "2MS", "QS", "YS", "W-MON", "2W-WED", "1h30min"])
def test_grid_equals_pandas(spark, frequency):
    rng = random.Random(frequency)
    span = {"30min": 3, "1h": 5, "7h": 20, "1h30min": 20}.get(frequency, 800)
    start = at("1969-11-20 08:10") if frequency in ("7h", "M") else at("2024-01-31 08:10")
    data = [(s, start + timedelta(days=rng.random() * span + 3 * (s == "b")), None if rng.random() < 0.2 else rng.random()) for s in "ab" for _ in range(60)]
    out = resample(frame(spark, data, f"station string, {T}, v double"), frequency, keys=["station"])
    got = [(r.station, r.DateTime, r.v) for r in out.select("station", "DateTime", "v").orderBy("station", "DateTime").collect()]
    want = []
    for s in "ab":
        one = pd.DataFrame([(t, v) for k, t, v in data if k == s], columns=["t", "v"]).astype({"v": float}).set_index("t").sort_index()
        want += [(s, t.to_pydatetime(), v) for t, v in one["v"].resample(PANDAS_NAMES.get(frequency, frequency)).mean().items()]
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(same(g[2], w[2]) for g, w in zip(got, want))


def test_long_gap_is_filled_in_blocks(spark):
    df = frame(spark, [("a", at("2024-01-01"), 1.0), ("a", at("2024-01-03 12:00:01"), 2.0)], f"station string, {T}, v double")
    out = resample(df, "1s", keys=["station"])
    n = 60 * 3600 + 2
    assert tuple(out.agg({"*": "count", "v": "count", "DateTime": "max"}).first()) == (2, n, at("2024-01-03 12:00:01"))
    assert out.select("DateTime").distinct().count() == n


def test_unkeyed_origin(spark):
    df = frame(spark, [(at("2024-01-01 08:10"), 1.0), (at("2024-01-02 00:00"), 2.0)], f"{T}, v double")
    assert [str(r[0]) for r in rows(resample(df, "7h"), "DateTime")] == ["2024-01-01 07:00:00", "2024-01-01 14:00:00", "2024-01-01 21:00:00"]


@pytest.mark.parametrize("frequency", ["30min", "7h", "2M"])
def test_unkeyed_equals_keyed(spark, frequency):
    rng = random.Random(frequency)
    data = [("a", at("2024-01-05") + timedelta(days=rng.random() * (400 if frequency == "2M" else 4)), rng.random()) for _ in range(40)]
    df = frame(spark, data, f"station string, {T}, v double")
    keyed = resample(df, frequency, keys=["station"], methods={"v": "sum"}).drop("station")
    alone = resample(df.drop("station"), frequency, methods={"v": "sum"})
    assert "SinglePartition" not in alone._jdf.queryExecution().executedPlan().toString()
    assert [(r[0], round(r[1], 9)) for r in rows(alone, "DateTime")] == [(r[0], round(r[1], 9)) for r in rows(keyed, "DateTime")]
    assert resample(df.drop("station").limit(0), frequency).count() == 0


def test_stats_and_contracts(spark):
    df = frame(spark, [(at("2024-01-01 00:10"), 1.0, "x"), (at("2024-01-01 02:10"), 1.0, "x")], f"{T}, v double, s string")
    with pytest.raises(DataProcessingError):
        resample(df, "1h")
    with pytest.raises(ValidationError):
        resample(df.select("v"), "1h")
    num = df.drop("s")
    r = resample_stats(num, resample(num, "1h"), "1h").first()
    assert (r.original_rows, r.downsampled_rows, round(r.reduction_factor, 6)) == (2, 3, 0.666667)
    assert aggregation_method("Met_Dir_1 []") == "circular_mean" and aggregation_method("zzz") == "mean"


def test_frequencies():
    assert parse_frequency("30s").seconds == parse_frequency("30S").seconds == 30
    assert parse_frequency("1h30min").seconds == 5400 and parse_frequency("500ms").step == 500_000 and parse_frequency("1d").seconds == 86400
    assert parse_frequency("1D").seconds == 86400 and parse_frequency("M").seconds is None
    for bad in ("", "1", "fortnight", "0h", "-1h", "1x", "1h1M", "W-XXX", "0W-MON"):
        with pytest.raises(ValidationError):
            parse_frequency(bad)


def test_steps_with_an_origin_read_the_source_once(spark, monkeypatch):
    from stationloom.operators import resample as module
    from stationloom.storage import materialize

    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Range (")
    stored = []
    monkeypatch.setattr(module, "materialize", lambda df, label: stored.append(scans(df)) or materialize(df, label))
    df = spark.range(5000).selectExpr("id % 3 AS station", "timestamp_ntz '2024-01-01 09:00' + make_dt_interval(0, 0, 0, id * 700) AS DateTime", "id * 1.0D AS v", "CAST(id AS DECIMAL(9, 2)) AS d")
    for frequency in ("7h", "2M", "7min"):
        out = resample(df, frequency, keys=["station"])
        assert scans(out) == 0 and out.schema["d"].dataType == resample(df, "1h", keys=["station"]).schema["d"].dataType
    assert stored == [1, 1, 1]
