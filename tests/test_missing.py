import random

import pytest
from pyspark.sql import functions as F

from helpers import at, frame, rows
from stationloom.errors import ValidationError
from stationloom.functions.names import abbreviate, file_prefix, title, wrap
from stationloom.operators import missing

T = "DateTime timestamp_ntz"


def table(spark, columns, data):
    return frame(spark, [(at(t), *v) for t, *v in data], f"{T}, " + ", ".join(f"`{n}` double" for n in columns))


def test_monthly_rates_and_hours(spark):
    df = table(spark, ["a", "b"], [("2024-01-01 05:59", 1.0, None), ("2024-01-01 06:00", None, None), ("2024-01-31 17:59", 1.0, 1.0), ("2024-03-01 18:00", 1.0, 1.0)])
    every = {(r.month, r.sensor): r.missing_rate for r in missing.monthly_missing_rate(df, "DateTime").collect()}
    assert every == {("2024-01", "a"): 1 / 3, ("2024-01", "b"): 2 / 3, ("2024-03", "a"): 0.0, ("2024-03", "b"): 0.0}
    day = {(r.month, r.sensor): r.missing_rate for r in missing.monthly_missing_rate(df, "DateTime", hours=(6, 18)).collect()}
    assert day == {("2024-01", "a"): 0.5, ("2024-01", "b"): 0.5}
    matrix = missing.missing_rate_matrix(missing.monthly_missing_rate(df, "DateTime"), ["2024-01", "2024-02", "2024-03"])
    assert rows(matrix, "sensor")[0] == ("a", "a", 1 / 3 * 100, None, 0.0)


def test_groups_and_their_rows(spark):
    names = ["x_WT_Ta", "x_WT-to-Sed_Ta", "SM_1", "y_SoilMoisture", "z"]
    groups = missing.sensor_groups(names, "microclimate")
    assert list(groups.values()) == ["microclimate_wt", "microclimate_wt_to_sed", "microclimate_soil_moisture", "microclimate_soil_moisture", "microclimate_other"]
    assert missing.sensor_groups(["SM_WT_a"], "power") == {"SM_WT_a": "power_wt"}
    assert missing.sensor_groups(names, "weather") == dict.fromkeys(names, "weather")
    assert missing.group_title("microclimate_wt", "microclimate") == "Microclimate (WT - Before Dec 2024)"
    assert missing.group_title("weather", "weather") == "Weather"
    df = table(spark, names, [
        ("2024-11-30 12:00", None, None, None, None, None),
        ("2024-11-30 13:00", 1.0, None, 1.0, None, 1.0),
        ("2024-12-01 12:00", None, None, None, None, None),
        ("2024-12-01 03:00", None, None, None, None, None),
    ])
    got = {(r.month, r.sensor): r.missing_rate for r in missing.missing_rate_by_group(df, "DateTime", "microclimate").collect()}
    assert got == {
        ("2024-11", "x_WT_Ta"): 0.5, ("2024-12", "x_WT-to-Sed_Ta"): 1.0, ("2024-11", "SM_1"): 0.0, ("2024-11", "y_SoilMoisture"): 1.0,
        ("2024-11", "z"): 0.5, ("2024-12", "z"): 1.0,
    }


def test_all_null_rows_and_summary(spark):
    df = table(spark, ["a", "b"], [("2024-01-01 07:00", None, None), ("2024-01-01 08:00", 1.0, None), ("2024-01-01 20:00", 1.0, 1.0)])
    assert missing.drop_all_null_rows(df, ["a", "b"]).count() == 2
    s = missing.task_missing_summary({"one": df, "two": df.select("DateTime", "b")}, "soil_moisture", "DateTime", (6, 18)).first()
    assert tuple(s) == ("Soil Moisture", 2, 2, 83.33, 2)
    none = missing.task_missing_summary({"one": df.limit(0)}, "power", "DateTime").first()
    assert none.missing_rate_pct == 0.0


def test_report_parts_at_any_size(spark):
    names = [("big", f"s{i:04d}") for i in range(995)] + [("small", "only")] + [("big", "s0001")] * 500
    parts = missing.report_parts(frame(spark, names, "group string, sensor string").repartition(11))
    got = {(r.group, r.sensor): (r.part, r.parts, r.part_label) for r in parts.collect()}
    assert len(got) == 996
    for i in range(995):
        assert got["big", f"s{i:04d}"] == (i // 10 + 1, 100, f"{i // 10 + 1}/100")
    assert got["small", "only"] == (1, 1, "1/1")
    titles = {(r.group, r.part): (r.title, r.stem) for r in missing.part_titles(parts, F.initcap("group")).collect()}
    assert titles["small", 1] == ("Small Missing Rate", "small_missing_rate")
    assert titles["big", 3] == ("Big Missing Rate (Part 3/100)", "big_missing_rate_part3")
    assert rows(missing.report_part_counts(parts), "group") == [("big", 100), ("small", 1)]


def test_names(spark):
    one = lambda f, text: frame(spark, [(text,)], "n string").select(f(F.col("n"))).first()[0]
    assert one(abbreviate, "GR_Temperature_Temperature__050cm_PVHgt_090cm") == "GR_Temp_ SH050 Hgt090"
    assert one(abbreviate, "A_A_B_A_(No Change)") == "A_B_A_NoChange"
    assert one(title, "soil_moisture") == "Soil Moisture"
    assert file_prefix("GR_1yr_yr_x") == "GR_x"
    short = lambda c: wrap(c, 10)
    assert one(short, "abc_def") == "abc_def"
    assert one(short, "abc_defgh_ijklmnopqrstuv_w_x") == "abc_defgh\nijklmnopqrstuv\nw_x"


def test_wrap_against_brute_force(spark):
    def greedy(name, room):
        lines = [""]
        for i, part in enumerate(name.split("_")):
            if i == 0:
                lines[-1] = part
            elif len(lines[-1]) + 1 + len(part) > room:
                lines.append(part)
            else:
                lines[-1] += "_" + part
        return "\n".join(lines)

    rng = random.Random(1)
    names = ["_".join("x" * rng.randrange(0, 9) for _ in range(rng.randrange(1, 9))) for _ in range(200)]
    got = frame(spark, [(i, n) for i, n in enumerate(names)], "i int, n string").select("i", wrap(F.col("n"), 12)).collect()
    assert all(text == greedy(names[i], 12) for i, text in got)


def test_pages_follow_the_columns():
    groups = {f"s{i}": "power_other" if i % 2 else "power_wt" for i in range(25)}
    pages = missing.column_pages(groups, 10)
    assert pages["s0"] == (1, 2) and pages["s18"] == (1, 2) and pages["s20"] == (2, 2) and pages["s23"] == (2, 2) and pages["s1"] == (1, 2)
    assert missing.page_title("Power", 2, 3) == "Power Missing Rate (Part 2/3)" and missing.page_title("Power", 1, 1) == "Power Missing Rate"


def test_no_table_no_summary():
    with pytest.raises(ValidationError):
        missing.task_missing_summary({}, "power", "DateTime")
