import gzip
import os

import pytest
from pyspark.sql import functions as F

from helpers import at, frame, rows
from stationloom.errors import DataParsingError, DataProcessingError, ValidationError
from stationloom.operators import missing
from stationloom.sources import files, logs, merge
from stationloom.storage import materialize


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


LOG = """BoardID:7
DateTime;Temp1,Humi1; ;Met_Speed1 ;
2024-04-01 00:00:00;21.5,80.1;1.2;
  2024-04-01 00:01:00;x,;1.5f;;;

2024-04-01 00:02:00;21.5,80.1;
nonsense;1,2;3
2024-04-01 00:03:00;-inf,1e2; 7 ;;
"""


def test_station_log(spark, tmp_path):
    write(f"{tmp_path}/a.txt", LOG)
    write(f"{tmp_path}/b.txt", LOG.replace("BoardID:7", "BoardID:8").replace("21.5", "99").replace("\n", "\r\n"))
    write(f"{tmp_path}/skip.log", LOG)
    df = logs.read_station_logs(spark, str(tmp_path))
    assert df.columns[3:] == ["DateTime", "Temp1", "Humi1", "Met_Speed1"]
    a = [tuple(r)[3:] for r in df.where(F.col("_source").endswith("a.txt")).orderBy(*files.ROW_ORDER).collect()]
    assert a == [
        (at("2024-04-01 00:00:00"), 21.5, 80.1, 1.2),
        (at("2024-04-01 00:01:00"), None, None, None),
        (None, 1.0, 2.0, 3.0),
        (at("2024-04-01 00:03:00"), float("-inf"), 100.0, 7.0),
    ]
    merged = merge.merge_station_logs(spark, str(tmp_path))
    assert merged.count() == 4 and {r.Temp1 for r in merged.collect()} == {21.5, None, 1.0, float("-inf")}
    assert logs.read_station_logs(spark, f"{tmp_path}/none") is None
    known = logs.read_station_logs(spark, str(tmp_path), columns=["DateTime", "Temp1", "Humi1", "Met_Speed1"])
    assert sorted(map(str, known.collect())) == sorted(map(str, df.collect()))


def test_logs_with_different_headers(spark, tmp_path):
    write(f"{tmp_path}/a.txt", LOG)
    write(f"{tmp_path}/b.txt", "BoardID:9\nHumi1,DateTime;New\n5,2024-05-01 00:00:00;6;\n")
    merged = merge.merge_station_logs(spark, str(tmp_path))
    assert set(merged.columns) == {"DateTime", "Temp1", "Humi1", "Met_Speed1", "New"}
    assert merged.where("New IS NOT NULL").select("DateTime", "Humi1", "New", "Temp1").first() == (at("2024-05-01"), 5.0, 6.0, None)
    write(f"{tmp_path}/bad/x.txt", "BoardID:9\nTime;a\n1;2\n")
    with pytest.raises(DataParsingError):
        logs.read_station_logs(spark, f"{tmp_path}/bad")


def test_head_lines_go_by_place_and_bad_sources_are_listed(spark, tmp_path):
    write(f"{tmp_path}/a/x.txt", "BoardID:1;fw,2;\nDateTime;Temp1,Humi1;\n2024-04-01 00:00:00;1,2;\nlate;3,4;\n2024-04-01 00:00:00;5,6;\n1;2\n")
    write(f"{tmp_path}/a/bad.txt", "BoardID:9\nTime;a\n1;2\n")
    write(f"{tmp_path}/b b/x.txt", "BoardID:2\nTemp1;DateTime;Dead;\n7;01/04/2024 00:05;x;\n")
    found = merge.merge_all_station_logs(spark, {"A": f"{tmp_path}/a", "B": f"file:{tmp_path}/b b/"}, time_formats=["dd/MM/yyyy HH:mm"])
    assert sorted(map(tuple, found.rows.select("device", "DateTime", "Temp1", "Humi1", "Dead").collect()), key=str) == sorted(
        [("A", at("2024-04-01"), 1.0, 2.0, None), ("A", None, 3.0, 4.0, None), ("B", at("2024-04-01 00:05"), 7.0, None, None)], key=str
    )
    assert sorted(map(tuple, found.layout.collect())) == [("A", "Humi1"), ("A", "Temp1"), ("B", "Dead"), ("B", "Temp1")]
    assert sorted((r.source.rsplit("/", 1)[1], r.lines, r.status) for r in found.audit.collect()) == [
        ("bad.txt", 3, "header without DateTime"), ("x.txt", 3, "ok"), ("x.txt", 6, "ok"),
    ]
    losses = {tuple(r)[1:] for r in found.losses.collect()}
    assert losses == {(4, 1, 1, 1), (1, 0, 0, 0)}
    with pytest.raises(DataParsingError, match="header without DateTime"):
        merge.merge_all_station_logs(spark, {"A": f"{tmp_path}/a"}, strict=True)


def test_known_columns_are_checked(spark, tmp_path):
    write(f"{tmp_path}/logs/a.txt", LOG)
    for wrong in (["DateTime", "Temp1"], ["Temp1", "DateTime", "Humi1", "Met_Speed1"]):
        with pytest.raises(Exception, match="differs from the known columns"):
            logs.read_station_logs(spark, f"{tmp_path}/logs", columns=wrong).collect()
    write(f"{tmp_path}/csv/a.csv", "Time,x,y\n2024-01-01 00:00:00,1,2\n")
    good = merge.merge_power(spark, f"{tmp_path}/csv", "*.csv", columns=["Time", "x", "y"])
    assert good.collect()[0].asDict() == {"DateTime": at("2024-01-01"), "x": 1.0, "y": 2.0}
    with pytest.raises(Exception, match="(?i)header"):
        merge.merge_power(spark, f"{tmp_path}/csv", "*.csv", columns=["Time", "y", "x"]).collect()


def test_large_log_is_split_over_tasks(spark, tmp_path):
    body = "".join(f"2024-04-01 {i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d};{i},1;2;\n" for i in range(20000))
    write(f"{tmp_path}/big.txt", LOG.split("2024")[0] + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = logs.read_station_logs(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 4
        assert tuple(df.agg(F.count("*"), F.sum("Temp1"), F.countDistinct("DateTime")).first()) == (20000, sum(range(20000)), 20000)
        order = [r.Temp1 for r in df.orderBy(*files.ROW_ORDER).select("Temp1").collect()]
        assert order == [float(i) for i in range(20000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_audit(spark, tmp_path):
    write(f"{tmp_path}/a.csv", "h\n1\n")
    write(f"{tmp_path}/b.csv", "")
    audit = files.audited_files(spark, str(tmp_path))
    assert sorted((r.source.rsplit("/", 1)[1], r.lines, r.status) for r in audit.collect()) == [("a.csv", 2, "ok"), ("b.csv", 0, "empty file")]
    files.require_some(audit)
    with pytest.raises(DataProcessingError):
        files.require_some(audit.where("status <> 'ok'"))


def test_unreadable_files_are_listed(spark, tmp_path):
    whole = gzip.compress(b"h\n1\n2\n")
    os.makedirs(f"{tmp_path}/in/deep")
    for name, content in {"ok.csv.gz": whole, "cut.csv.gz": whole[:12], "deep/plain.csv": b"h\n1\n", "empty.csv": b""}.items():
        with open(f"{tmp_path}/in/{name}", "wb") as f:
            f.write(content)
    audit = files.audited_files(spark, f"{tmp_path}/in", recursive=True, skip_unreadable=True)
    assert sorted((os.path.basename(r.source), r.bytes, r.lines, r.status) for r in audit.collect()) == [
        ("cut.csv.gz", 12, 0, "no readable line"), ("empty.csv", 0, 0, "empty file"), ("ok.csv.gz", len(whole), 3, "ok"), ("plain.csv", 4, 2, "ok"),
    ]
    with pytest.raises(Exception, match="(?i)EOF|unexpected end|cut.csv"):
        files.audited_files(spark, f"{tmp_path}/in").collect()
    with pytest.raises(ValidationError):
        files.audited_files(spark, f"{tmp_path}/none")
    # names of files with content stay in the tasks
    found = files.found_files(spark, f"{tmp_path}/in", "*.{gz,txt}", empty=False)
    assert "cut.csv" not in found._jdf.queryExecution().toString()
    assert sorted(os.path.basename(r[files.SOURCE]) for r in found.collect()) == ["cut.csv.gz", "ok.csv.gz"]
    assert [r.bytes for r in files.found_files(spark, f"{tmp_path}/in", "e*.{csv,txt}").collect()] == [0]


def test_losses_of_power_and_weather(spark, tmp_path):
    write(f"{tmp_path}/Chart PV_a_Data1.csv", "Time,x\n2024-01-01 00:05:00,5\nbad,6\n2024-01-01 00:05:00,7\n2024-01-01 00:10:00,\n")
    write(f"{tmp_path}/Chart PV_b_Data1.csv", "Time,x\n2024-01-01 00:05:00,9\n2024-01-01 00:15:00,1\n")
    done = merge.merge_power_files(spark, str(tmp_path))
    assert rows(done.rows, "DateTime") == [(at("2024-01-01 00:05"), 5.0), (at("2024-01-01 00:10"), None), (at("2024-01-01 00:15"), 1.0)]
    assert sorted(tuple(r)[1:] for r in done.losses.collect()) == [(2, 0, 1), (4, 1, 1)]
    assert "Chart PV" not in done.losses._jdf.queryExecution().optimizedPlan().toString()
    write(f"{tmp_path}/w/Air_temperature.csv", "Date,Time,Degree Celsius\n01.02.2024,00:00,1\n2024/02/01,00:00:00,2\nx,y,3\n")
    w = merge.merge_weather_files(spark, f"{tmp_path}/w", time_formats=["dd.MM.yyyy HH:mm"], known={"Air_temperature.csv": ["Date", "Time", "Degree Celsius"]})
    assert rows(w.rows, "DateTime") == [(at("2024-02-01"), 1.0)] and [tuple(r)[1:] for r in w.losses.collect()] == [(3, 1, 1)]


def test_power(spark, tmp_path):
    write(f"{tmp_path}/Chart PV_roof_Data1.csv", "Time,Optimizer 1.1- Production - Power (W)\n2024-01-01 00:05:00,5\nbad,6\n2024-01-01 00:10:00,\n")
    write(f"{tmp_path}/Chart PV_roof_Data2.csv", "Optimizer 1.1- Production - Power (W),DateTime,\"Optimizer 2,2\"\n9,2024-01-01 00:05:00,1\n10,2024-01-01 00:15:00,2\n")
    write(f"{tmp_path}/Chart PV_roof_Data3.csv", "")
    write(f"{tmp_path}/other.csv", "Time,x\n2024-01-01 00:05:00,1\n")
    df = merge.merge_power(spark, str(tmp_path))
    got = rows(df.select("DateTime", "`Optimizer 1.1- Production - Power (W)`", "`Optimizer 2,2`"), "DateTime")
    assert got == [(at("2024-01-01 00:05"), 5.0, None), (at("2024-01-01 00:10"), None, None), (at("2024-01-01 00:15"), 10.0, 2.0)]
    with pytest.raises(ValidationError):
        merge.merge_power(spark, f"{tmp_path}/none")


def test_weather(spark, tmp_path):
    head = "Date,Time,"
    write(f"{tmp_path}/Air_temperature.csv", head + "Degree Celsius\n2024/01/01,00:00:00,1\n2024/01/01,00:00:00,2\n2024-01-01,01:00:00,3\n2024/01/01,02:00:00,x\n")
    write(f"{tmp_path}/Wind Velocity.csv", head + "m/s,Degree\n2024/01/01,02:00:00,4,5\n2024/01/01,03:00:00,,6\n")
    write(f"{tmp_path}/GHI.csv", "When,w/m2\n1,2\n")
    write(f"{tmp_path}/Visibility.csv", head + "km\n2024/01/01,02:00:00,4\n")
    df = merge.merge_weather(spark, str(tmp_path))
    assert df.columns == ["DateTime", "Air_Temp_C", "WindSpeed_ms", "WindDirection_deg"]
    assert rows(df, "DateTime") == [
        (at("2024-01-01 00:00"), 1.0, None, None), (at("2024-01-01 02:00"), None, 4.0, 5.0), (at("2024-01-01 03:00"), None, None, 6.0),
    ]
    with pytest.raises(DataProcessingError):
        merge.merge_weather(spark, f"{tmp_path}/none")


def test_device_sheets(spark, tmp_path):
    write(f"{tmp_path}/Time1/dev 1.csv", "DateTime,Temp_1 []\n2024-01-01 00:00:00,1\n2024-01-01 00:01:00,2\nbad,3\n")
    write(f"{tmp_path}/Time2/dev 1.csv", "DateTime,Temp_1 [],Humi_1 []\n2024-01-01 00:01:00,9,9\n2024-01-01 00:02:00,4,5\nworse,6,6\n")
    write(f"{tmp_path}/Time2/dev2.csv", "DateTime,Temp_1 [],Humi_1 []\n2024-01-01 00:01:00,7,8\n")
    table, layout = merge.read_device_tables(spark, str(tmp_path))
    assert {r.device for r in layout.collect()} == {r.device for r in table.collect()}
    df = table.select("device", "DateTime", "`Temp_1 []`", "`Humi_1 []`")
    assert rows(df, "device", "DateTime") == [
        ("dev 1", None, 3.0, None), ("dev 1", at("2024-01-01 00:00"), 1.0, None), ("dev 1", at("2024-01-01 00:01"), 2.0, None),
        ("dev 1", at("2024-01-01 00:02"), 4.0, 5.0), ("dev2", at("2024-01-01 00:01"), 7.0, 8.0),
    ]


def test_combine_prefixed(spark):
    t = "DateTime timestamp_ntz, v double"
    a = frame(spark, [(at("2024-01-01"), 1.0), (at("2024-01-02"), 2.0)], t)
    b = frame(spark, [(at("2024-01-02"), 3.0), (at("2024-01-03"), 4.0)], t)
    df = merge.combine_prefixed({"B_1yr": b, "A_yr": a})
    assert df.columns == ["DateTime", "A_v", "B_v"]
    assert rows(df, "DateTime") == [(at("2024-01-01"), 1.0, None), (at("2024-01-02"), 2.0, 3.0), (at("2024-01-03"), None, 4.0)]
    with pytest.raises(Exception, match="duplicate times"):
        merge.combine_prefixed({"A": a.unionAll(a), "B": b}).collect()


def test_typed_csv_round_trip(spark, tmp_path):
    df = frame(spark, [(at("2024-01-01 00:00"), 1.5), (at("2024-01-01 01:00:00.000001"), None)], "DateTime timestamp_ntz, `a.b []` double")
    files.write_table(df, f"{tmp_path}/t", sort_by=["DateTime"], fmt="csv")
    back = merge.read_typed_csv(spark, f"{tmp_path}/t")
    assert back.columns == df.columns and rows(back, "DateTime") == rows(df, "DateTime")


def scanned_rows(df) -> int:
    """Rows that came out of the scan of a table, by its metric."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_clustered_files_follow_each_other_in_time(spark, tmp_path):
    """A hot device, rows without a time and copies of a time; periods are read from few row groups."""
    schema = "device string, `Date.Time` timestamp_ntz, v long, tags map<string,int>, l array<long>"
    n = F.col("id")
    time = F.when(n % 50 == 0, None).when(n % 7 == 0, F.lit("2024-02-01")).otherwise(F.timestamp_seconds(1_704_067_200 + n * 60))
    df = spark.range(60_000).select(
        F.when(n % 3 == 0, "a/b").otherwise((n % 5).cast("string")).alias("device"), time.cast("timestamp_ntz").alias("Date.Time"),
        n.alias("v"), F.create_map(F.lit("k"), F.lit(1)).alias("tags"), F.array(n).alias("l"),
    )
    path = f"{tmp_path}/t"
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    files.write_table(df, path, ["device"], ["Date.Time"], cluster=True)
    for k, v in before.items():
        spark.conf.set(k, v)
    back = spark.read.schema(schema).parquet(path)
    assert back.count() == 60_000 and back.agg(F.sum("v")).first()[0] == sum(range(60_000))
    borders = back.where("`Date.Time` IS NOT NULL").groupBy("device", F.col("_metadata.file_path").alias("file")).agg(
        F.min("`Date.Time`").alias("first"), F.max("`Date.Time`").alias("last")
    )
    by_device: dict = {}
    for device, _, first, last in sorted(borders.collect(), key=lambda r: (r[0], r[2], r[3])):
        by_device.setdefault(device, []).append((first, last))
    assert len(by_device["a/b"]) > 1
    assert all(x[1] <= y[0] for spans in by_device.values() for x, y in zip(spans, spans[1:]))
    period = files.read_period(spark, path, back.schema, "Date.Time", "2024-01-03", "2024-01-05")
    assert period.columns == back.columns
    assert period.count() == df.where("`Date.Time` BETWEEN TIMESTAMP_NTZ'2024-01-03' AND TIMESTAMP_NTZ'2024-01-05'").count() > 0
    assert period.count() <= scanned_rows(period) < 60_000 / 4
    files.write_table(df.limit(0), f"{tmp_path}/none", ["device"], ["Date.Time"], cluster=True)
    assert files.read_period(spark, f"{tmp_path}/none", back.schema, "Date.Time", None, "2024-01-05", True).count() == 0
    with pytest.raises(ValidationError, match="of its own"):
        files.write_table(df.withColumn(files.CLUSTER_TIME, F.lit(1)), path, ["device"], ["Date.Time"], cluster=True)


def text_scans(df) -> int:
    """Scans of text files in the plan of a table."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("] text")


def log_folder(tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    (folder / "a.txt").write_text(
        "BoardID:1\nDateTime;T1,H1;\n2024-01-01 00:00:00;1,2;\n2024-01-01 00:00:00;3,4;\nnever;5,6;\n2024-01-01 01:00:00;7\n\n"
        "BoardID:1\nDateTime;T1,H1;\n DateTime ;T1,H1;\n2024-01-01 02:00:00;x,8;\n"
    )
    (folder / "b.txt").write_text("BoardID:2\nDateTime;H1;T1\n2024-01-01 00:00:00;9;10\n")
    (folder / "c.txt").write_text("BoardID:3\nnothing;here\n1;2\n")
    return str(folder)


def test_logs_are_stored_once_with_reasons(spark, tmp_path):
    lines = files.read_lines(spark, log_folder(tmp_path), "*.txt")
    parsed = logs.parse_logs(lines)
    assert [text_scans(x) for x in (parsed.lines, parsed.rows(), parsed.audit(), parsed.losses(), parsed.columns())] == [0] * 5
    reasons = {r["source"]: r for r in parsed.lines.groupBy(F.regexp_extract("_source", "([a-z]).txt$", 1).alias("source")).pivot("reason").count().collect()}
    a = reasons["a"]
    assert (a["ok"], a["no time"], a["wrong width"], a["head"], a["repeated head"], a["blank"]) == (3, 1, 1, 4, 1, 1)
    assert (reasons["b"]["ok"], reasons["b"]["head"], reasons["c"]["no usable header"]) == (1, 2, 3)
    assert parsed.lines.where("reason = 'ok' AND _text IS NOT NULL OR reason <> 'ok' AND _text IS NULL").count() == 0
    same = lambda x, y: sorted(map(str, x.collect())) == sorted(map(str, y.collect()))
    assert same(parsed.audit(), logs.log_audit(lines)) and same(parsed.losses(), logs.log_losses(lines))
    assert same(logs.without_order(parsed.rows()), logs.without_order(logs.parse_log_lines(lines)))
    losses = {r.source[-5:]: tuple(r)[1:] for r in parsed.losses().collect()}
    assert losses == {"a.txt": (5, 1, 1, 1), "b.txt": (1, 0, 0, 0)}


def test_known_columns_save_the_look_at_the_heads(spark, tmp_path, monkeypatch):
    folder = log_folder(tmp_path)
    lines = files.read_lines(spark, [f"{folder}/a.txt"])
    stored = []
    monkeypatch.setattr(logs, "materialize", lambda df, label: stored.append((label, text_scans(df))) or materialize(df, label))
    known, found = logs.parse_logs(lines, columns=["DateTime", "T1", "H1"]), logs.parse_logs(lines)
    assert stored == [("log-lines", 1), ("log-heads", 0), ("log-heads", 1), ("log-lines", 1)]
    same = lambda x, y: sorted(map(str, x.collect())) == sorted(map(str, y.collect()))
    assert same(logs.without_order(known.rows()), logs.without_order(found.rows()))
    assert same(known.audit(), found.audit()) and same(known.losses(), found.losses()) and same(known.columns(), found.columns())
    with pytest.raises(Exception, match="differs from the known columns"):
        logs.parse_logs(files.read_lines(spark, [f"{folder}/b.txt"]), columns=["DateTime", "T1", "H1"]).rows().collect()


def test_all_logs_of_a_job_read_the_text_twice(spark, tmp_path, monkeypatch):
    stored = []
    monkeypatch.setattr(logs, "materialize", lambda df, label: stored.append(text_scans(df)) or materialize(df, label))
    done = merge.merge_all_station_logs(spark, {"S": log_folder(tmp_path)})
    later = [text_scans(x) for x in (done.rows, done.layout, done.audit, done.losses)]
    assert (sum(stored), sum(later)) == (2, 0)
    assert {(r.device, r.column) for r in done.layout.collect()} == {("S", "T1"), ("S", "H1")}


def test_any_number_of_files_in_one_scan(spark, tmp_path, monkeypatch):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(2000):
        (folder / f"t{i}_1yr.csv").write_text(f'DateTime,v{i}\n2024-01-01 {7 + i % 2:02d}:00:00,{i}\n')
    (folder / "odd, name.csv").write_text('"a, ""b""",DateTime,c\n1,2024-01-01 07:00:00,\n"3",2024-01-01 08:00:00,NaN\n\nx\n')
    (folder / "timeless.csv").write_text("a,b\n1,2\n")
    (folder / "empty.csv").write_text("")
    stored = []
    monkeypatch.setattr(merge, "materialize", lambda df, label: stored.append(text_scans(df)) or materialize(df, label))
    long = merge.read_long(spark, str(folder))
    assert sum(stored) == 1 and text_scans(long.rows) == text_scans(long.sensors) == 0
    assert long.sensors.count() == 2002 and long.sensors.where("sensor = 't7_v7' AND table = 't7_1yr' AND place = 1").count() == 1
    odd = long.readings().where("table = 'odd, name'").select("sensor", "time", "value")
    assert rows(odd, "time", "sensor") == [
        ("odd, name_a, \"b\"", None, None), ("odd, name_c", None, None),
        ("odd, name_a, \"b\"", at("2024-01-01 07:00"), 1.0), ("odd, name_c", at("2024-01-01 07:00"), None),
        ("odd, name_a, \"b\"", at("2024-01-01 08:00"), 3.0), ("odd, name_c", at("2024-01-01 08:00"), None),
    ]
    rates = missing.long_missing_rates(long, "weather")
    assert len(rates.columns) == 5 and len(rates._jdf.queryExecution().optimizedPlan().toString()) < 30_000
    got = {r.sensor: r.missing_rate for r in rates.collect()}
    assert len(got) == 2002 and got["t7_v7"] == 0.5 and got["odd, name_a, \"b\""] == 0.0 and got["odd, name_c"] == 1.0


def test_long_rates_equal_those_of_the_aligned_table(spark):
    t = "DateTime timestamp_ntz, `x_WT` double, `y_WT-to-Sed` double, SM_1 double"
    hours = [at(f"2024-{m:02d}-{d:02d} {h:02d}:00") for m in (11, 12) for d in (1, 2) for h in (5, 8, 12, 17, 18)]
    one = frame(spark, [(x, *[float(i) if (i + k) % 3 else None for k in range(3)]) for i, x in enumerate(hours)], t)
    two = frame(spark, [(x, float(i), None, float("nan")) for i, x in enumerate(hours[3:]) if i % 2] + [(None, 1.0, 1.0, 1.0)], t)
    tables = {"B_1yr": one, "A": two}
    for kind in ("microclimate", "power", "weather"):
        wide = missing.missing_rate_by_group(merge.combine_prefixed(tables), "DateTime", kind, per_part=2)
        long = merge.long_tables(tables)
        found = missing.paged_rates(missing.long_missing_rates(long, kind), long.sensors, kind, 2)
        assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, found.collect()))
