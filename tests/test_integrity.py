import random
from datetime import date, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from helpers import at, frame, rows
from stationloom.errors import DataIntegrityError, ValidationError
from stationloom.operators import integrity, series
from stationloom.sources.files import write_table

T = "DateTime timestamp_ntz"


def test_keep_first_and_count(spark):
    data = [("a", at("2024-01-01"), 2, "late"), ("a", at("2024-01-01"), 1, "early"), ("a", None, 3, "n1"), ("a", None, 4, "n2"), ("b", at("2024-01-01"), 9, "b")]
    df = frame(spark, data, f"device string, {T}, line int, v string")
    first = integrity.dedupe_keep_first(df, ["device", "DateTime"], [F.col("line")])
    assert sorted(r.v for r in first.collect()) == ["b", "early", "n1"]
    assert tuple(integrity.duplicate_count(df, ["device", "DateTime"]).first()) == (5, 2)
    clean, n = integrity.check_duplicates(df, ["device", "DateTime"], [F.col("line")])
    assert n == 2 and clean.count() == 3
    with pytest.raises(DataIntegrityError):
        integrity.check_duplicates(df, ["device"], [F.col("line")], raise_on_error=True)


def test_hot_copies_are_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = integrity.dedupe_keep_first(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_missing_and_ranges(spark):
    df = frame(spark, [(1.0, None, 0.0), (2.0, None, 5.0), (3.0, 1.0, 10.0), (4.0, None, 11.0)], "a double, b double, c double")
    assert integrity.check_missing(df, ["a", "b", "c"]) == {"b": 0.75}
    with pytest.raises(DataIntegrityError):
        integrity.check_missing(df, ["b"], raise_on_error=True)
    assert integrity.check_value_ranges(df, {"c": (0, 10), "a": (2, 3), "b": (0, 9), "zzz": (0, 1)}) == {"c": 1, "a": 2}
    with pytest.raises(DataIntegrityError):
        integrity.check_value_ranges(df, {"c": (0, 10)}, raise_on_error=True)
    assert integrity.check_value_ranges(df, {"zzz": (0, 1)}) == {}


def test_temporal_report_against_brute_force(spark):
    rng = random.Random(5)
    data = [(s, at("2024-01-01") + timedelta(seconds=rng.choice([60, 60, 60, 300, 90000]) * k + rng.randrange(3))) for s in ("a", "b") for k in range(200)]
    data += [("one", at("2024-01-01")), ("b", None)] + [("a", data[0][1])] * 50
    df = frame(spark, data, f"station string, {T}").repartition(7)
    report = {r.station: r for r in series.temporal_consistency(df, "DateTime", ["station"], 60, chunk_seconds=1800).collect()}
    gaps = series.temporal_gaps(df, "DateTime", 60, ["station"], chunk_seconds=1800).collect()
    for s in ("a", "b"):
        times = sorted(t for k, t in data if k == s and t)
        steps = [(b - a).total_seconds() for a, b in zip(times, times[1:])]
        r = report[s]
        assert (r.median_interval_s, r.min_interval_s, r.max_interval_s) == (median(steps), min(steps), max(steps))
        assert (r.start, r.end, r.backwards, r.total_records) == (times[0], times[-1], 0, 200 + (s == "b") + 50 * (s == "a"))
        want = sorted((a, b, d) for a, b, d in zip(times, times[1:], steps) if d > 120)
        assert r.gap_count == len(want)
        assert sorted((g.start, g.end, g.duration_s) for g in gaps if g.station == s) == want
    assert report["one"].median_interval_s is None and report["one"].total_records == 1


def test_unkeyed_report_and_strict_mode(spark):
    df = frame(spark, [(at("2024-01-01 00:00"),), (at("2024-01-01 00:01"),), (at("2024-01-01 05:00"),)], T)
    r = integrity.check_temporal(df, "DateTime", 60).first()
    assert (r.total_records, r.gap_count, r.max_interval_s) == (3, 1, 299 * 60)
    with pytest.raises(DataIntegrityError):
        integrity.check_temporal(df, "DateTime", 60, raise_on_error=True)
    with pytest.raises(ValidationError):
        integrity.check_temporal(df, "nope")


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1001])
def test_exact_median(spark, n):
    rng = random.Random(n)
    values = [rng.choice([rng.randrange(-50, 50), rng.randrange(10**12)]) for _ in range(n)]
    hist = frame(spark, [(v, 1) for v in values], "v long, n long").groupBy("v").agg(F.sum("n").alias("n"))
    assert series.exact_median(hist, "v", "n").first()["median"] == median(values)


def test_table_contracts(spark):
    df = frame(spark, [("2024-01-01 10:00:00", 1.0), ("bad", 2.0)], "DateTime string, v double")
    assert integrity.validate_table(df, ["v"], min_rows=2) is df
    for args in ((["zzz"], 1), ([], 3)):
        with pytest.raises(ValidationError):
            integrity.validate_table(df, *args)
    empty = df.limit(0)
    assert integrity.validate_table(empty, allow_empty=True) is empty
    with pytest.raises(ValidationError):
        integrity.validate_table(empty)
    with pytest.raises(ValidationError):
        integrity.validate_table([1])
    typed = integrity.validate_time_column(df, "DateTime")
    assert typed.dtypes[0] == ("DateTime", "timestamp_ntz") and rows(typed, "v")[0][0] == at("2024-01-01 10:00") and rows(typed, "v")[1][0] is None
    as_date = integrity.validate_time_column(frame(spark, [(date(2024, 1, 1),)], "DateTime date"), "DateTime")
    assert as_date.first()[0] == at("2024-01-01")
    for name in ("zzz", "v"):
        with pytest.raises(ValidationError):
            integrity.validate_time_column(df, name)
    summary = integrity.table_summary(typed, "DateTime").first()
    assert (summary.records, summary.columns, summary.start) == (2, 2, at("2024-01-01 10:00"))


def scans(df) -> int:
    """Scans of the source, a range in these tests, in the plan of a table."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("Range (")


def test_temporal_report_reads_the_source_once(spark, monkeypatch):
    from stationloom.storage import materialize

    stored = []
    monkeypatch.setattr(series, "materialize", lambda df, label: stored.append((label, scans(df))) or materialize(df, label))
    df = spark.range(5000).selectExpr("id % 3 AS station", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id * 7) AS DateTime")
    for unique in (False, True):
        del stored[:]
        report, gaps = series.temporal_consistency(df, "DateTime", ["station"], 5, unique_times=unique), series.temporal_gaps(df, "DateTime", 5, ["station"], unique_times=unique)
        assert [x for x in stored if x[1]] == [("slice-summaries", 1), ("slice-edges", 1)]
        assert scans(report) == scans(gaps) == 0
        r = {x.station: x for x in report.collect()}
        assert (r[0].total_records, r[0].median_interval_s, r[0].gap_count, gaps.count()) == (1667, 21.0, 1666, 4997)


def test_temporal_report_of_nothing_and_of_nulls(spark):
    none = frame(spark, [], f"station string, {T}")
    assert series.temporal_consistency(none, "DateTime", ["station"], 60).collect() == []
    whole = series.temporal_consistency(none, "DateTime", [], 60).first()
    assert (whole.total_records, whole.start, whole.median_interval_s) == (0, None, None)
    nulls = frame(spark, [(None, None), (None, None), (None, at("2024-01-01")), ("a", None)], f"station string, {T}")
    for unique in (False, True):
        got = {r.station: (r.total_records, r.start, r.gap_count) for r in series.temporal_consistency(nulls, "DateTime", ["station"], 60, unique_times=unique).collect()}
        assert got == {None: (3, at("2024-01-01"), 0), "a": (1, None, None)}


def test_contract_is_measured_by_the_write(spark, tmp_path):
    nan = float("nan")
    df = spark.createDataFrame(
        [(at("2024-01-01"), 1.0, "a"), (None, nan, "a"), (at("2024-01-02"), 7.0, "b"), (at("2024-01-03"), None, "b"), (at("2024-01-04"), -1.0, "b")],
        "DateTime timestamp_ntz, x double, device string",
    )
    contract = integrity.TableContract(("DateTime", "y"), 3, 0, {"x": (0, 5), "gone": (0, 1)}, 2)
    expected = [
        ("required_column", "DateTime", 1, 1, None, True), ("required_column", "y", 0, 1, None, False), ("rows", None, 5, 3, None, True),
        ("without_time", "DateTime", 1, None, 0, False), ("out_of_range", "x", 2, None, 2, True),
    ]
    assert [tuple(r) for r in integrity.contract_report(df, "DateTime", contract).collect()] == expected
    for by in ((), ("device",)):
        watch = integrity.ContractWatch("DateTime", contract)
        write_table(df, f"{tmp_path}/t{len(by)}", by, ["DateTime"], measure=watch.watch)
        assert watch.report() == expected and spark.read.parquet(f"{tmp_path}/t{len(by)}").count() == 5
    strict = integrity.ContractWatch("DateTime", integrity.TableContract(max_without_time=0, strict=True))
    strict.watch(df).write.parquet(f"{tmp_path}/strict")
    with pytest.raises(DataIntegrityError, match="without_time of DateTime: 1"):
        strict.report()
    empty = integrity.TableContract(("x",), 1, ranges={"x": (0, 1)})
    assert [r.found for r in integrity.contract_report(df.limit(0), "DateTime", empty).collect()] == [1, 0, 0, 0]
    watch = integrity.ContractWatch("DateTime", empty)
    watch.watch(df.where("device = 'none'")).write.parquet(f"{tmp_path}/empty")
    assert [r[2] for r in watch.report()] == [1, 0, 0, 0]
