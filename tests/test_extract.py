import pytest

from helpers import at, frame, rows
from stationloom.errors import ValidationError
from stationloom.operators.extract import date_range, join_sources, select_rename, split_columns_by_date, split_rows_by_date, split_stats

T = "DateTime timestamp_ntz"


@pytest.fixture()
def table(spark):
    times = ["2024-11-30 23:00", "2024-12-01 00:00", "2024-12-01 00:05", None]
    return frame(spark, [(at(t) if t else None, float(i), 10.0 * i) for i, t in enumerate(times)], f"{T}, `WT (W)` double, other double")


def test_select_rename(table):
    out = select_rename(table, {"DateTime": "DateTime", "WT (W)": "a.b", "gone": "x"})
    assert out.columns == ["DateTime", "a.b"]
    assert select_rename(table, {"gone": "x"}) is None and select_rename(table, None) is table


def test_date_range(table):
    assert [r[1] for r in rows(date_range(table, "DateTime", "2024-11-30", "2024-12-01"), "DateTime")] == [0.0, 1.0]
    assert [r[1] for r in rows(date_range(table, "DateTime", "2024-11-30", "2024-12-01", True), "DateTime")] == [0.0, 1.0, 2.0]
    assert date_range(table, "DateTime", None, None).count() == 3


def test_filter_reaches_the_scan(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "t"))
    df = select_rename(date_range(spark.read.parquet(str(tmp_path / "t")), "DateTime", "2024-11-30", "2024-12-01"), {"DateTime": "DateTime", "other": "o"})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(DateTime" in plan and "ReadSchema: struct<DateTime:timestamp_ntz,other:double>" in plan


def test_join_sources(spark, table):
    other = frame(spark, [(at("2024-12-01 00:00"), 7.0), (at("2025-01-01 00:00"), 8.0)], f"{T}, x double")
    out = join_sources(table, [(other, {"x": "y", "zzz": "q"}), (other, {"zzz": "q"})], ["DateTime"])
    assert rows(out, "DateTime") == [(at("2024-12-01 00:00"), 1.0, 10.0, 7.0)]
    with pytest.raises(ValidationError):
        join_sources(table, [(other, {"x": "other"})], ["DateTime"])


def test_splits(table):
    parts = split_rows_by_date(table, "DateTime", "2024-12-01", "_WT", "_WT-to-Sed")
    assert [(r.other, r.part) for r in parts.orderBy("DateTime").collect()] == [(0.0, "_WT"), (10.0, "_WT-to-Sed"), (20.0, "_WT-to-Sed")]
    cols = split_columns_by_date(table, "DateTime", "2024-12-01")
    assert cols.columns == ["DateTime", "other", "WT (W)_part1", "WT (W)_part2"]
    assert [tuple(r)[1:] for r in cols.orderBy("other").collect()] == [(0.0, 0.0, None), (10.0, None, 1.0), (20.0, None, 2.0), (30.0, None, None)]
    kept = split_columns_by_date(table, "DateTime", "2024-12-01", keep_original=True)
    assert kept.columns[:3] == ["DateTime", "WT (W)", "other"]
    assert split_columns_by_date(table, "DateTime", "2024-12-01", ("nope",)) is None
    assert tuple(split_stats(table, "DateTime", "2024-12-01").first()) == (4, 1, 2)
