import json
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import at, rows
from stationloom import rules
from stationloom.errors import ConfigurationError, DataIntegrityError, ValidationError
from stationloom.operators import integrity
from stationloom.plans import pipeline
from stationloom.plans.pipeline import PipelineConfig, check_stages, choose_stage, run_name, run_pipeline
from stationloom.plans.quality import QualityRules, quality_control, total_flagged
from stationloom.plans.report import load_tables, missing_rate_report

RANGES = {
    "microclimate": {
        "temperature": {"unit": "C", "lower_bound": 0, "upper_bound": 60, "applies_to": ["Temp", "TC_Temp"], "description": "air"},
        "wind_direction": {"unit": "degrees", "lower_bound": 0, "upper_bound": 360, "applies_to": ["Met_Dir"]},
        "soil": {"unit": "%", "lower_bound": 0, "upper_bound": 100, "applies_to": ["SoilMoisture"]},
    },
    "power": {
        "pv_power": {
            "unit": "W", "lower_bound": 0, "upper_bound": 1000, "applies_to": ["Optimizer"],
            "time_dependent": {"enabled": True, "daytime": {"hours": [7, 17], "lower_bound": 1}, "nighttime": {"lower_bound": 0}},
        }
    },
    "weather": {"air_temperature": {"unit": "C", "lower_bound": 0, "upper_bound": 60, "applies_to": ["Air_Temp_C"]}},
}
CONSTANT = {"enabled": True, "window_days": 1, "tolerance": 1e-6, "applies_to": {"temperature": {"patterns": ["Temp", "TC"]}, "wind": {"patterns": ["Met_"], "enabled": False}}}
FAILURES = {"sensor_failures": {"microclimate/devA.csv": {"start": "2024-11-29", "end": "2024-11-30", "sensors": ["Temp_"]}}}
GAPS = {"enabled": True, "settings": {"max_gap_minutes": 2, "mark_interpolated": True}, "data_types": {"temperature": {"enabled": True, "applies_to": ["Temp"]}, "power": {"enabled": False, "applies_to": ["Optimizer"]}}}
TASKS = {
    "description": "d",
    "settings": {"date_range": {"start_date": "2024-11-28", "end_date": "2024-12-04"}},
    "power": {"files": [{"input": "power/power_merged.csv", "output": "power/PV_Power.csv", "columns": {"DateTime": "DateTime", "Optimizer 3.2.1- Production - Power (W)": "WT_PVAz180", "Optimizer 2.2.20- Production - Power (W)": "PV_PVR"}}]},
    "microclimate": {
        "files": [
            {"input": "microclimate/devA.csv", "output": "microclimate/Roof_WedTri.csv", "columns": {"DateTime": "DateTime", "Temp_1 []": "Ta_180cm", "absent": "x"},
             "merge_from": {"input": "anywhere/GR.csv", "columns": {"Temp1": "Ta_050cm"}}},
            {"input": "microclimate/GR.csv", "output": "microclimate/GR.csv", "columns": {"DateTime": "DateTime", "Met_Dir1": "Wdir"}, "date_range": {"end_date": "2024-12-01"}},
            {"input": "microclimate/devA.csv", "output": "microclimate/none.csv", "columns": {"absent": "x"}},
            {"input": "microclimate/devA.csv", "output": "dead/all.csv", "columns": "all"},
            {"input": "microclimate/nodevice.csv", "output": "microclimate/none2.csv", "columns": {"DateTime": "DateTime"}},
        ]
    },
    "weather": {"files": [{"input": "weather/weather_merged.csv", "output": "weather/hourly.csv", "columns": "all"}]},
}


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    start = at("2024-11-28 00:00")
    half_hours = [start + timedelta(minutes=30 * i) for i in range(48 * 7)]
    sheet = "DateTime,Temp_1 [],SoilMoisture [],Dead []\n"
    # 3 December is stuck, 1 December 03:00-04:59 is missing
    for i, t in enumerate(half_hours):
        if t.month == 12 and t.day == 1 and t.hour in (3, 4):
            continue
        temp = 20.0 if (t.month, t.day) == (12, 3) else 10 + i % 5
        sheet += f"{t},{temp},{50 if t.day == 28 else ''},\n"
    write(f"{root}/sheets/Time1/devA.csv", sheet)
    write(f"{root}/logs/GR/a.txt", "BoardID:1\nDateTime;Temp1;Met_Dir1;\n" + "".join(f"{t};{5 + i % 3};{350 if i % 2 else 10};\n" for i, t in enumerate(half_hours)))
    write(f"{root}/power/Chart PV_roof_Data1.csv", "Time,Optimizer 3.2.1- Production - Power (W),Optimizer 2.2.20- Production - Power (W)\n" + "".join(f"{t},{100 if 7 <= t.hour < 17 else 0},{2000 if t.hour == 12 else 5}\n" for t in half_hours))
    write(f"{root}/weather/Air_temperature.csv", "Date,Time,Degree Celsius\n" + "".join(f"{t:%Y/%m/%d},{t:%H:%M:%S},{15 + t.hour / 10}\n" for t in half_hours[::2]))
    write(f"{root}/weather/Wind Velocity.csv", "Date,Time,m/s,Degree\n" + "".join(f"{t:%Y/%m/%d},{t:%H:%M:%S},1,90\n" for t in half_hours[::4]))
    return root


def config(root, out, **changes):
    base = dict(
        output_root=out, device_sheets=f"{root}/sheets", station_logs={"GR": f"{root}/logs/GR"}, power=f"{root}/power", weather=f"{root}/weather",
        ranges={k: rules.range_rules(RANGES, k) for k in RANGES}, constants=rules.constant_rules(CONSTANT),
        failures=rules.failure_windows(FAILURES["sensor_failures"]), gaps=rules.gap_rules(GAPS), tasks=rules.extract_tasks(TASKS), run_id="run",
    )
    return PipelineConfig(**{**base, **changes})


def test_whole_job(spark, folder, tmp_path):
    done = run_pipeline(spark, config(folder, str(tmp_path)))
    micro = done.stages["quality_controlled"]["microclimate"].where("device = 'devA'")
    temp = {r.DateTime: r["Temp_1 []"] for r in micro.collect()}
    assert temp[at("2024-11-28 10:00")] is not None
    assert temp[at("2024-11-29 10:00")] is None and temp[at("2024-11-30 00:00")] is None and temp[at("2024-11-30 00:30")] is not None
    assert temp[at("2024-12-03 10:00")] is None
    stuck = done.stats["constant_values_microclimate"].where("device = 'devA'").first()
    assert (stuck.flagged_count, stuck.dates) == (48, ["2024-12-03"])
    assert done.stats["failures_microclimate"].first().affected_timestamps == 49
    day = done.stats["boundaries_power"].where("sensor LIKE 'Optimizer 3.2.1%'").first()
    assert (day.initial_count, day.prefiltered_count, day.flagged_count) == (7 * 20, 7 * 28, 0)

    hourly = {r.DateTime: r for r in done.stages["interpolated"]["microclimate"].where("device = 'devA'").collect()}
    assert hourly[at("2024-12-01 03:00")]["Temp_1 []_interpolated"] and hourly[at("2024-12-01 03:00")]["Temp_1 []"] is not None
    assert hourly[at("2024-12-03 01:00")]["Temp_1 []"] is not None and hourly[at("2024-12-03 12:00")]["Temp_1 []"] is None
    directions = [r.Met_Dir1 for r in done.stages["downsampled"]["microclimate"].where("device = 'GR'").collect()]
    assert all(min(d, 360 - d) < 1e-9 for d in directions)

    assert sorted(done.extracted) == ["dead/all", "microclimate/GR", "microclimate/Roof_WedTri__WT", "microclimate/Roof_WedTri__WT-to-Sed", "power/PV_Power", "weather/hourly"]
    before, since = done.extracted["microclimate/Roof_WedTri__WT"], done.extracted["microclimate/Roof_WedTri__WT-to-Sed"]
    assert before.columns == ["DateTime", "Ta_180cm", "Ta_050cm"]
    assert before.agg(F.max("DateTime")).first()[0] == at("2024-11-30 23:00") and since.agg(F.max("DateTime")).first()[0] == at("2024-12-04")
    assert done.extracted["microclimate/GR"].agg(F.max("DateTime")).first()[0] == at("2024-12-01")
    power = done.extracted["power/PV_Power"]
    assert power.columns == ["DateTime", "PV_PVR", "WT_PVAz180_WT", "WT_PVAz180_WT-to-Sed"]
    assert set(done.extracted["weather/hourly"].columns) >= {"DateTime", "Air_Temp_C", "WindSpeed_ms", "WindDirection_deg"}

    summary = done.stats["missing_summary_power"].first()
    assert (summary.task, summary.total_sensors, summary.files) == ("Power", 2, 1)
    rates = {(r.group, r.sensor, r.month): r.missing_rate for r in done.stats["missing_rate"].collect()}
    assert rates["power_wt", "PV_Power_WT_PVAz180_WT", "2024-11"] == pytest.approx(2 / 12)
    assert ("power_wt", "PV_Power_WT_PVAz180_WT", "2024-12") not in rates
    assert rates["power_other", "PV_Power_PV_PVR", "2024-11"] == pytest.approx(1 / 12)
    assert rates["microclimate_wt_to_sed", "Roof_WedTri__WT-to-Sed_Ta_180cm", "2024-12"] > 0
    assert {r.missing_rate for r in done.stats["missing_rate"].where("sensor LIKE '%Dead%'").collect()} == {1.0}
    assert [(r.lines, r.status) for r in done.stats["sources_logs"].collect()] == [(2 + 48 * 7, "ok")]
    assert [tuple(r)[1:] for r in done.stats["losses_logs"].collect()] == [(48 * 7, 0, 0, 0)]
    assert [tuple(r)[2:] for r in done.stats["sources_power"].collect()] == [(48 * 7, 0, 0, "ok")]
    assert sorted(tuple(r)[2:] for r in done.stats["sources_weather"].collect()) == [(12 * 7, 0, 0, "ok"), (24 * 7, 0, 0, "ok")]
    merged = {(r["table"], r.rule): (r.found, r.ok) for r in done.stats["contracts_merged"].collect()}
    assert merged["merged/power", "rows"] == (48 * 7, True) and merged["merged/weather", "without_time"] == (0, True)
    matrix = {(r.group, r.sensor): r for r in done.stats["missing_rate_matrix"].collect()}
    page = matrix["power_wt", "PV_Power_WT_PVAz180_WT"]
    assert (page.title, page.label) == ("Power (WT - Before Dec 2024) Missing Rate", "PV_Power_WT_PVAz180_WT")
    assert page["2024-11"] == pytest.approx(100 * 2 / 12) and page["2024-12"] is None
    assert {r.group: r.part_count for r in done.stats["report_part_counts"].collect()}["power_other"] == 1
    assert done.stats["temporal_power"].first().median_interval_s == 1800
    again = spark.read.parquet(f"{done.root}/extracted/microclimate/GR")
    assert rows(again, "DateTime") == rows(done.extracted["microclimate/GR"], "DateTime")


def test_measured_values_only(spark, folder, tmp_path):
    done = run_pipeline(spark, config(folder, str(tmp_path), downsample=False, interpolate=False, device_sheets=None, station_logs={}, weather=None, table_format="csv", report=False,
                                      known_columns={"power": ["Time", "Optimizer 3.2.1- Production - Power (W)", "Optimizer 2.2.20- Production - Power (W)"]}))
    assert list(done.stages) == ["merged", "quality_controlled"] and sorted(done.extracted) == ["power/PV_Power"]
    power = done.extracted["power/PV_Power"]
    assert power.count() == 48 * 6 + 1 and power.agg(F.max("DateTime")).first()[0] == at("2024-12-04")


def test_strict_contract_ends_the_run(spark, folder, tmp_path):
    only_power = dict(device_sheets=None, station_logs={}, weather=None, report=False, downsample=False, interpolate=False)
    name = "Optimizer 2.2.20- Production - Power (W)"
    strict = integrity.TableContract(ranges={name: (0, 1000)}, max_out_of_range=0, strict=True)
    with pytest.raises(DataIntegrityError, match="out_of_range"):
        run_pipeline(spark, config(folder, str(tmp_path), contracts={"merged/power": strict}, **only_power))
    assert pipeline.stored_stages(spark, f"{tmp_path}/run") == {}
    # out of range is masked by quality control, so the same contract holds one stage on
    done = run_pipeline(spark, config(folder, str(tmp_path), contracts={"quality_controlled/power": strict}, **only_power))
    found = [tuple(r) for r in done.stats["contracts_quality_controlled"].where("rule = 'out_of_range'").collect()]
    assert found == [("quality_controlled/power", "out_of_range", name, 0, None, 0, True)]


def test_stage_choice_and_guards(spark, tmp_path):
    stages = {"quality_controlled": {"a": 1}, "downsampled": {"a": 2}, "interpolated": {"a": 3}}
    assert choose_stage(stages, True, True) == {"a": 3} and choose_stage(stages, True, False) == {"a": 2} and choose_stage(stages, False, False) == {"a": 1}
    assert choose_stage({"quality_controlled": {"a": 1}}, True, True) == {"a": 1}
    with pytest.raises(ConfigurationError):
        check_stages(False, True)
    assert run_name(True, False, at("2025-12-27 02:26:35")) == "20251227_022635_downsample_true_interpolate_false"
    with pytest.raises(ConfigurationError):
        run_pipeline(spark, PipelineConfig(str(tmp_path), frequency="M"))
    assert pipeline.device_table({}, {}, "power/x") is None


def test_quality_control_without_matching_rules(spark):
    df = spark.createDataFrame([(at("2024-01-01"), 1.0)], "DateTime timestamp_ntz, x double")
    done = quality_control(df, QualityRules(rules.range_rules(RANGES, "power")), "DateTime")
    assert done.table.collect() == df.collect() and not done.stats
    assert total_flagged(done).first()[0] == 0


def test_statistics_of_one_pass_equal_single_ones(spark):
    data = [(d, at("2024-01-01") + timedelta(hours=7 * k), float(k % 70), float(k % 13)) for d in ("a", "b", "c") for k in range(40)]
    df = spark.createDataFrame(data, "device string, DateTime timestamp_ntz, Temp_1 double, Optimizer double")
    ranges = rules.range_rules(RANGES, "microclimate") + rules.range_rules(RANGES, "power")
    windows = [rules.FailureWindow("a", "2024-01-02", "2024-01-05", ("Temp",)), rules.FailureWindow("x", "2024-01-02", "2024-01-05", ("Temp",))]
    run = lambda stored: quality_control(df, QualityRules(ranges, (), windows), "DateTime", ["device"], F.col("device"), store_stats=stored)
    one, single = run(True), run(False)
    assert sorted(map(str, one.stats["boundaries"].collect())) == sorted(map(str, single.stats["boundaries"].collect()))
    assert sorted(map(str, one.stats["failures"].collect())) == sorted(map(str, single.stats["failures"].collect()))
    assert sorted(map(str, one.table.collect())) == sorted(map(str, single.table.collect()))


def test_total_flagged(spark):
    df = spark.createDataFrame([(at("2024-01-01"), 100.0), (at("2024-01-02 00:00"), 5.0), (at("2024-01-02 01:00"), 5.0)], "DateTime timestamp_ntz, Temp double")
    done = quality_control(df, QualityRules(rules.range_rules(RANGES, "microclimate"), rules.constant_rules(CONSTANT)), "DateTime")
    assert total_flagged(done).first()[0] == 3


def test_rule_files(tmp_path):
    def put(name, content):
        path = str(tmp_path / name)
        write(path, content if isinstance(content, str) else json.dumps(content))
        return path

    r = rules.load_range_rules(put("r.json", RANGES), "power")
    assert r[0].day_night == rules.DayNight(7, 17, 1, 0) and r[0].plain_bounds_text == "0 to 1000 W"
    assert rules.range_rule_info(rules.range_rules(RANGES, "microclimate"))["temperature"] == {"description": "air", "range": "0 to 60 C", "patterns": ["Temp", "TC_Temp"]}
    with pytest.raises(ValidationError):
        rules.load_range_rules(put("r.json", RANGES), "noise")
    with pytest.raises(ConfigurationError):
        rules.load_range_rules(str(tmp_path / "none.json"), "power")
    with pytest.raises(ConfigurationError):
        rules.load_range_rules(put("bad.json", "{"), "power")
    assert [c.category for c in rules.load_constant_rules(put("c.json", CONSTANT))] == ["temperature"]
    assert rules.load_constant_rules(str(tmp_path / "none.json")) == []
    with pytest.raises(ConfigurationError):
        rules.load_constant_rules(put("broken.json", "{"))
    assert rules.constant_rules({"enabled": False, "applies_to": {"a": {"patterns": ["x"]}}}) == []
    assert rules.load_failure_windows(put("f.json", FAILURES)) == [rules.FailureWindow("microclimate/devA", "2024-11-29", "2024-11-30", ("Temp_",))]
    assert len(rules.load_failure_windows(str(tmp_path / "none.json"))) == 2 and rules.load_failure_windows(str(tmp_path / "bad.json")) == []
    g = rules.load_gap_rules(put("g.json", GAPS))
    assert (g.limit_rows, [x.data_type for x in g.rules]) == (2, ["temperature"])
    t = rules.load_extract_tasks(put("t.json", TASKS), ["power"])
    assert list(t.tasks) == ["power"] and (t.start, t.end) == ("2024-11-28", "2024-12-04")
    assert rules.list_tasks(put("t.json", TASKS)) == ["power", "microclimate", "weather"]
    with pytest.raises(ConfigurationError):
        rules.load_extract_tasks(put("t.json", TASKS), ["nope"])
    with pytest.raises(ConfigurationError):
        rules.require_keys({"a": 1}, ["a", "b"])


def test_report_goes_on_after_a_failure(spark, tmp_path):
    write(f"{tmp_path}/GR_1yr.csv", "DateTime,v\n2024-01-01 07:00:00,1\n2024-01-01 08:00:00,\n")
    write(f"{tmp_path}/R x.csv", "DateTime,SM_1\n2024-01-01 07:00:00,1\n")
    write(f"{tmp_path}/empty.csv", "")
    tables = load_tables(spark, str(tmp_path))
    assert rows(tables.sensors, "table") == [("GR_1yr", 1, "GR_v"), ("R x", 1, "R x_SM_1")]
    one = spark.createDataFrame([(at("2024-01-01 07:00"), 1.0)], "DateTime timestamp_ntz, SM_1 double")
    double = one.unionAll(one)
    report = missing_rate_report({"microclimate": tables, "power": {"twice": double}, "weather": {}})
    got = {(r.data_type, r.group, r.sensor): (r.missing_rate, r.part, r.parts, r.title) for r in report.rates.collect()}
    assert got == {
        ("microclimate", "microclimate_other", "GR_v"): (0.5, 1, 1, "Microclimate (Other) Missing Rate"),
        ("microclimate", "microclimate_soil_moisture", "R x_SM_1"): (0.0, 1, 1, "Microclimate (Soil Moisture) Missing Rate"),
    }
    assert sorted(report.failed) == ["power", "weather"] and "duplicate times" in report.failed["power"]
    assert missing_rate_report({"power": {"twice": double}}).rates is None
    with pytest.raises(ValidationError):
        load_tables(spark, f"{tmp_path}/none")


def test_a_run_is_taken_up_after_its_last_whole_stage(spark, folder, tmp_path, monkeypatch):
    cfg = config(folder, str(tmp_path), station_logs={}, weather=None)
    with monkeypatch.context() as m:
        def broken(*_):
            raise RuntimeError("ended here")

        m.setattr(pipeline, "ruled_columns", broken)
        with pytest.raises(RuntimeError, match="ended here"):
            run_pipeline(spark, cfg)
    stages = pipeline.stored_stages(spark, f"{tmp_path}/run")
    # a table of the broken stage lies there, but its record does not say done
    assert os.path.isdir(f"{tmp_path}/run/interpolated/microclimate") and sorted(stages) == ["downsampled", "merged", "quality_controlled"]

    def unread(*_):
        raise AssertionError("inputs are not to be read")

    monkeypatch.setattr(pipeline, "merge_kinds", unread)
    done = run_pipeline(spark, cfg)
    assert sorted(done.stages["interpolated"]) == ["microclimate", "power"]
    assert {"summary_power", "temporal_power", "boundaries_power", "interpolation_microclimate"} <= set(done.stats)
    assert done.extracted["power/PV_Power"].count() > 0
    # other settings of a stage: it and the later ones run again
    other = run_pipeline(spark, config(folder, str(tmp_path), station_logs={}, weather=None, frequency="2h"))
    assert other.stages["downsampled"]["power"].count() < stages["quality_controlled"]["power"].count() / 3
    with pytest.raises(AssertionError, match="not to be read"):
        run_pipeline(spark, config(folder, str(tmp_path), station_logs={}, weather=None, power=None))


def test_extraction_from_an_earlier_run(spark, folder, tmp_path):
    cfg = config(folder, str(tmp_path), station_logs={}, weather=None, interpolate=False, report=False, run_id="first")
    first = run_pipeline(spark, cfg)
    later = pipeline.extract_from_run(spark, first.root, config(folder, str(tmp_path), run_id="second"))
    assert sorted(later.extracted) == sorted(first.extracted) and later.root.endswith("/second")
    for name, df in first.extracted.items():
        assert rows(later.extracted[name], "DateTime") == rows(df, "DateTime")
    measured = pipeline.extract_from_run(spark, first.root, config(folder, str(tmp_path), run_id="third", downsample=False, interpolate=False))
    assert measured.extracted["power/PV_Power"].count() > first.extracted["power/PV_Power"].count()
    with pytest.raises(pipeline.DataProcessingError):
        pipeline.extract_from_run(spark, f"{tmp_path}/nothing", cfg)
