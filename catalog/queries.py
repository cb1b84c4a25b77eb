"""One query per operator, on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import inputs as i
from stationloom.columns import c, classify_expr
from stationloom.functions.names import abbreviate, wrap
from stationloom.functions.parse import parse_date_and_time, parse_number, parse_time
from stationloom.operators import constant, extract, integrity, masks, missing, resample, series
from stationloom.operators import interpolate as gaps
from stationloom.plans import pipeline, quality
from stationloom.rules import ExtractFile, ExtractSource, ExtractTasks
from stationloom.sources import files, logs, merge
from stationloom.storage import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

TIME = "DateTime"
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c(n), digits).alias(n) if n in names else c(n) for n in df.columns])


# --- sources and merging -------------------------------------------------------------------------


@query
def parse_station_log(spark, sf):
    rows = logs.parse_log_lines(i.log_lines(spark, sf))
    return logs.without_order(rows.withColumn("source", files.stem(F.col(files.SOURCE))))


@query
def merge_station_logs(spark, sf):
    rows = logs.parse_log_lines(i.log_lines(spark, sf)).withColumn("source", F.col(files.SOURCE))
    first = integrity.dedupe_keep_first(rows, ["source", TIME], [F.col(n) for n in files.ROW_ORDER])
    return logs.without_order(first)


@query
def parse_date_time_columns(spark, sf):
    o = i.table(spark, sf, "orders")
    date = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.date_format("o_orderdate", "dd.MM.yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy/MM/dd")
    )
    time = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "HH:mm:ss"))
    return o.select("o_orderkey", parse_date_and_time(date, time).alias(TIME))


@query
def source_file_audit(spark, sf):
    return files.file_audit(i.log_lines(spark, sf), min_lines=3)


@query
def failed_sources(spark, sf):
    """The first five sources that cannot be used, as an error names them."""
    return files.first_failed(logs.log_audit(i.log_lines(spark, sf)))


@query
def time_contract(spark, sf):
    """Per status: rows, rows without a time, and the range of the others."""
    o = i.table(spark, sf, "orders")
    text = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "no time").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return integrity.time_contract(o.select(F.col("o_orderstatus").alias("status"), text.alias(TIME)), TIME, ["status"])


@query
def table_contract(spark, sf):
    """What a table of readings has to hold, counted in one aggregation: rows, times, ranges, a column that is not there."""
    o = i.table(spark, sf, "orders")
    text = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "no time").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    typed = integrity.validate_time_column(o.select(text.alias(TIME), "o_totalprice", "o_custkey"), TIME)
    contract = integrity.TableContract(
        required_columns=(TIME, "o_totalprice", "humidity"), min_rows=1000, max_without_time=0,
        ranges={"o_totalprice": (1000.0, 200000.0), "o_custkey": (1, 10**9), "humidity": (0, 100)}, max_out_of_range=0,
    )
    return integrity.contract_report(typed, TIME, contract)


@query
def power_file_losses(spark, sf):
    """What the merge of power files leaves out of each: rows without a time, copies of a time that an earlier file or row has."""
    o = i.table(spark, sf, "orders")
    rows = o.select(
        F.concat(F.lit("power/"), F.col("o_custkey") % 7, F.lit(".csv")).alias(files.SOURCE),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderdate").cast("timestamp_ntz")).alias(TIME), "o_orderkey",
    )
    kept = integrity.dedupe_keep_first(rows.where(F.col(TIME).isNotNull()), [TIME], [F.col(files.SOURCE), F.col("o_orderkey")])
    return merge.file_losses(rows, kept)


@query
def log_source_audit(spark, sf):
    return logs.log_audit(i.log_lines(spark, sf))


@query
def merge_loss_counts(spark, sf):
    return logs.log_losses(i.log_lines(spark, sf))


@query
def merge_devices(spark, sf):
    w = i.wide(spark, sf).withColumn(TIME, F.date_trunc("minute", TIME).cast("timestamp_ntz"))
    w = w.withColumnRenamed("station", "device")
    first = w.where("event_id % 2 = 0").select("device", TIME, "event_id", "click", "error", "purchase")
    second = w.where("event_id % 2 = 1 OR event_id % 3 = 0").select("device", TIME, "event_id", "signup", "click", "view")
    return merge.merge_devices([first, second], order=[F.col("event_id")])


@query
def merge_power(spark, sf):
    o = i.table(spark, sf, "orders")
    text = o.select(
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "no time")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("Time"),
        F.col("o_totalprice").cast("string").alias("Optimizer 1.1 (W)"),
        F.col("o_orderkey"),
    )
    rows = merge.power_rows(files.CsvTable(text, {"": ("Time", "Optimizer 1.1 (W)")}))
    first = integrity.dedupe_keep_first(rows, [TIME], [F.col("o_orderkey")])
    return first.select(TIME, "o_orderkey", c("Optimizer 1.1 (W)").alias("power"))


@query
def merge_weather_full_outer(spark, sf):
    return merge.merge_full_outer([(i.minute_source(spark, sf, s), ["event_id"]) for s in i.SENSORS])


@query
def combine_prefixed_sources(spark, sf):
    tables = {"A_1yr": "click", "B_yr": "error", "C": "view", "D_yr_1yr": "purchase", "E": "signup"}
    return merge.combine_prefixed({name: i.hourly_source(spark, sf, s) for name, s in tables.items()})


@query
def long_csv_tables(spark, sf):
    path = scratch_path(spark, "long-csv")
    for name, s in {"A_1yr": "click", "B_yr": "error", "C": "view"}.items():
        files.write_table(i.hourly_source(spark, sf, s), f"{path}/{name}", sort_by=[TIME], fmt="csv")
    files.write_table(i.hourly_source(spark, sf, "signup").drop("mean"), f"{path}/E, 1", fmt="csv")
    folder = files.stem(F.regexp_extract(F.col(files.SOURCE), "^(.*)/[^/]*$", 1))
    return merge.read_long(spark, path, recursive=True, table=folder).readings()


def _uneven_tables(spark, sf):
    """Hourly tables with other hours and columns each, some values missing."""
    tables = {"a_WT": "click", "b_WT-to-Sed": "error", "c_SM_": "view", "d": "purchase", "e_WT_SM_": "signup"}
    hole = F.when(F.col("max") < 900, F.col("max"))
    return {
        name: i.hourly_source(spark, sf, s).withColumn("max", hole).where(F.hour(TIME) != k) for k, (name, s) in enumerate(tables.items())
    }


@query
def missing_rate_long(spark, sf):
    tables = merge.long_tables(_uneven_tables(spark, sf))
    rates = missing.long_missing_rates(tables, "microclimate", (6, 18), change_date="2024-01-16")
    pages = missing.paged_rates(rates, tables.sensors, "microclimate", 2)
    return rounded(pages, "missing_rate")


@query
def csv_scan(spark, sf):
    """Written as CSV and read back: header, text columns, typed by the scan."""
    path = scratch_path(spark, "csv")
    files.write_table(i.wide(spark, sf), path, sort_by=[TIME], fmt="csv")
    return merge.read_typed_csv(spark, path)


@query
def csv_mixed_headers(spark, sf):
    """Two groups of files with the same rows, other columns in another order, in one folder."""
    path, w = scratch_path(spark, "csv"), i.wide(spark, sf)
    files.write_table(w.select(TIME, "event_id", "click", "error", "purchase"), f"{path}/a", fmt="csv")
    files.write_table(w.select("station", "event_id", "view", TIME, "signup", "click"), f"{path}/b", fmt="csv")
    table = files.read_csv_table(spark, path, "*.csv", recursive=True)
    return table.rows.select(
        parse_time(F.col(TIME)).alias(TIME), *[parse_number(c(n)).alias(n) for n in table.columns if n != TIME]
    )


@query
def partitioned_sink(spark, sf):
    """Written as a table partitioned by station and read back."""
    path, w = scratch_path(spark, "sink"), i.wide(spark, sf)
    files.write_table(w, path, ["station"], [TIME])
    return spark.read.schema(w.schema).parquet(path)


@query
def clustered_sink(spark, sf):
    """Rows of a period, from a table whose files follow each other in time within a station."""
    path, w = scratch_path(spark, "clustered"), i.wide(spark, sf)
    files.write_table(w, path, ["station"], [TIME], cluster=True)
    return files.read_period(spark, path, w.schema, TIME, "2024-01-10", "2024-01-20")


# --- extraction ----------------------------------------------------------------------------------


@query
def extract_rename(spark, sf):
    names = {"event_id": "id", TIME: "time", "click": "Ta_180cm", "view": "RH_050cm [%]", "absent": "x"}
    return extract.select_rename(i.wide(spark, sf), names)


@query
def extract_date_range(spark, sf):
    return extract.date_range(i.wide(spark, sf), TIME, "2024-01-05", "2024-01-20")


@query
def extract_date_range_daily(spark, sf):
    o = i.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias(TIME))
    return extract.date_range(o, TIME, "1996-01-01", "1998-06-30")


@query
def extract_join(spark, sf):
    base, *others = (i.hourly_source(spark, sf, s) for s in i.SENSORS)
    base = extract.select_rename(base, {TIME: TIME, "mean": "click_mean", "max": "click_max"})
    period = lambda df: extract.date_range(df, TIME, "2024-01-03", "2024-01-28")
    sources = [(period(df), {"mean": f"{s}_mean", "max": f"{s}_max", "absent": "x"}) for df, s in zip(others, i.SENSORS[1:])]
    return extract.join_sources(period(base), [*sources, (period(others[0]), {"absent": "y"})], [TIME])


@query
def extract_task_records(spark, sf):
    """Extraction tasks over the tables of all devices: the datasets and how many records each has."""
    table = i.wide(spark, sf, with_id=False).withColumn("station", i.station_key()).withColumnRenamed("station", "device")
    even = tuple(
        ExtractFile(f"events/s{k}", f"power/s{k}", {TIME: TIME, "click": "a", "absent": "x"}, start="2024-01-10") for k in range(0, 10, 2)
    )
    odd = tuple(
        ExtractFile(f"events/s{k}", f"climate/s{k}", {TIME: TIME, "view": "v"}, end="2024-01-12",
                    merge_from=(ExtractSource(f"other/s{k}", {"error": "e"}),))
        for k in range(1, 10, 2)
    )
    whole = ExtractFile("events/s0", "climate/all_columns")
    tasks = ExtractTasks({"power": even, "climate": (*odd, whole, ExtractFile("events/s77", "climate/none"))}, "2024-01-02", "2024-01-28")
    columns = {"events": pipeline.present_columns(table, [f"s{k}" for k in (*range(10), 77)])}
    found = [
        df.agg(F.count("*").alias("records")).select(
            F.lit(task).alias("task"), F.lit(output).alias("output"), "records", F.lit(",".join(df.columns)).alias("columns")
        )
        for task, output, df in pipeline.extract_tasks(tasks, {"events": table}, columns)
    ]
    return merge.union_by_name(found)


@query
def split_rows_by_date(spark, sf):
    return extract.split_rows_by_date(i.wide(spark, sf), TIME, "2024-01-16", "_WT", "_WT-to-Sed")


@query
def split_columns_by_date(spark, sf):
    return extract.split_columns_by_date(i.wide(spark, sf), TIME, "2024-01-16", ("cl", "view"))


@query
def split_stats(spark, sf):
    return extract.split_stats(i.wide(spark, sf), TIME, "2024-01-16", ["station"])


@query
def classify_sensors(spark, sf):
    p = i.table(spark, sf, "part")
    rules = {"joint": ("bolt", "ring"), "colour": ("red", "blue"), "grade": ("ECONOMY", "SMALL")}
    name = F.concat_ws("_", "p_name", "p_type")
    return p.select("p_partkey", classify_expr(name, rules, "other").alias("kind"))


# --- quality control -----------------------------------------------------------------------------


@query
def qc_range_mask(spark, sf):
    return masks.range_mask(i.wide(spark, sf), i.RANGES, TIME, ["event_id", "station"])


@query
def qc_range_stats(spark, sf):
    stats = masks.range_stats(i.wide(spark, sf), i.RANGES, TIME, ["station"], ["event_id"])
    stats = stats.select("station", "sensor", "variable_type", "initial_count", "flagged_count", "flagged_percentage", "bounds")
    return rounded(stats, "flagged_percentage")


@query
def qc_time_range_mask(spark, sf):
    return masks.range_mask(i.wide(spark, sf), i.TIMED_RANGES, TIME, ["event_id", "station"])


@query
def qc_time_range_stats(spark, sf):
    stats = masks.range_stats(i.wide(spark, sf), i.TIMED_RANGES, TIME, [], ["event_id", "station"])
    return rounded(stats, "flagged_percentage", "daytime_percentage", "nighttime_percentage")


@query
def qc_failure_mask(spark, sf):
    return masks.failure_mask(i.wide(spark, sf), i.WINDOWS, i.station_key(), TIME, ["event_id", "station"])


@query
def qc_failure_mask_many(spark, sf):
    return masks.failure_mask(i.wide(spark, sf), i.MANY_WINDOWS, i.station_key(), TIME, ["event_id", "station"])


def _failure_stats(df, windows):
    stats = masks.failure_stats(df, windows, i.station_key(), TIME, ["event_id"], keys=["station"])
    return stats.withColumn("affected_columns", F.concat_ws(",", "affected_columns")).withColumn(
        "sensor_patterns", F.concat_ws(",", "sensor_patterns")
    )


@query
def qc_failure_stats(spark, sf):
    return _failure_stats(i.wide(spark, sf), i.WINDOWS)


@query
def qc_failure_stats_many(spark, sf):
    return _failure_stats(i.wide(spark, sf), i.MANY_WINDOWS)


@query
def daily_std(spark, sf):
    std = constant.daily_std(i.wide(spark, sf, with_id=False), TIME, ["station"])
    return rounded(std, *i.SENSORS)


@query
def qc_constant_days(spark, sf):
    return constant.constant_days(i.shipments(spark, sf), i.CONSTANT_RULES, TIME, ["station"])


@query
def qc_constant_mask(spark, sf):
    rows = i.shipments(spark, sf)
    return constant.constant_mask(rows, constant.constant_days(rows, i.CONSTANT_RULES, TIME, ["station"]), TIME, ["station"])


@query
def qc_constant_stats(spark, sf):
    flagged = constant.constant_days(i.shipments(spark, sf), i.CONSTANT_RULES, TIME, ["station"])
    return constant.constant_stats(flagged, ["station"]).withColumn("dates", F.array_join("dates", ","))


@query
def qc_total_flagged(spark, sf):
    rules = quality.QualityRules(i.SHIP_RANGES, i.CONSTANT_RULES, i.SHIP_WINDOWS)
    return quality.total_flagged(quality.quality_control(i.shipments(spark, sf), rules, TIME, ["station"], F.col("station")))


@query
def qc_full(spark, sf):
    rules = quality.QualityRules(i.SHIP_RANGES, i.CONSTANT_RULES, i.SHIP_WINDOWS)
    return quality.quality_control(i.shipments(spark, sf), rules, TIME, ["station"], F.col("station")).table


# --- resampling and gap filling ------------------------------------------------------------------


@query
def resample_mean(spark, sf):
    return i.grid(spark, sf)


@query
def resample_sum(spark, sf):
    sums = {s: "sum" for s in i.SENSORS}
    return resample.resample(i.wide_hundredths(spark, sf), "1h", TIME, ["station"], sums)


def _directions(spark, sf):
    w = i.wide_hundredths(spark, sf)
    return w.select(
        "station", TIME, (F.col("click") % 360).alias("Met_Dir1"), (F.col("view") * 7 % 360).alias("Met_Dir2"),
        F.col("error").alias("Temp1"), F.col("signup").alias("WindDirection_deg"), F.col("purchase").alias("other"),
    )


@query
def resample_circular_mean(spark, sf):
    df = resample.resample(_directions(spark, sf).select("station", TIME, "Met_Dir1", "Met_Dir2"), "1h", TIME, ["station"])
    return df.select("station", TIME, *[F.pmod(F.round(c(n), 6), F.lit(360.0)).alias(n) for n in ("Met_Dir1", "Met_Dir2")])


@query
def resample_mixed(spark, sf):
    df = resample.resample(_directions(spark, sf), "30min", TIME, ["station"])
    return df.select(
        *[F.pmod(F.round(c(n), 6), F.lit(360.0)).alias(n) if n.startswith("Met") else c(n) for n in df.columns]
    )


@query
def resample_stats(spark, sf):
    w = i.wide(spark, sf, with_id=False)
    stats = resample.resample_stats(w, resample.resample(w, "1h", TIME, ["station"]), "1h")
    return rounded(stats, "reduction_factor")


def _order_totals(spark, sf):
    return i.table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias(TIME), i.hundredths(F.col("o_totalprice")).alias("price"),
    )


@query
def resample_daily(spark, sf):
    return resample.resample(_order_totals(spark, sf), "1D", TIME, ["status"])


@query
def resample_week(spark, sf):
    return resample.resample(_order_totals(spark, sf), "W", TIME, ["status"])


@query
def resample_month(spark, sf):
    return resample.resample(_order_totals(spark, sf), "M", TIME, ["status"])


@query
def resample_quarter(spark, sf):
    return resample.resample(_order_totals(spark, sf), "Q", TIME, ["status"])


@query
def resample_year(spark, sf):
    return resample.resample(_order_totals(spark, sf), "Y", TIME, ["status"])


@query
def resample_two_months(spark, sf):
    return resample.resample(_order_totals(spark, sf), "2M", TIME, ["status"])


@query
def resample_month_start(spark, sf):
    return resample.resample(_order_totals(spark, sf), "MS", TIME, ["status"])


@query
def resample_week_monday(spark, sf):
    return resample.resample(_order_totals(spark, sf), "W-MON", TIME, ["status"])


@query
def resample_ninety_minutes(spark, sf):
    return i.grid(spark, sf, "1h30min")


@query
def frequency_bins(spark, sf):
    """The bins of many frequencies that the orders of a status fall into."""
    frequencies = ("6h", "1d", "W", "W-WED", "M", "MS", "Q", "QS", "Y", "YS")
    found = [
        resample.resample(_order_totals(spark, sf), f, TIME, ["status"], {"price": "sum"})
        .groupBy("status").agg(F.count("*").alias("bins"), F.min(TIME).alias("first"), F.max(TIME).alias("last"), F.sum("price").alias("total"))
        .select(F.lit(f).alias("frequency"), "status", "bins", "first", "last", "total")
        for f in frequencies
    ]
    return merge.union_by_name(found)


@query
def resample_seven_hours(spark, sf):
    return i.grid(spark, sf, "7h")


def _stored_grid(spark, sf, frequency="1h"):
    """As between the stages of a pipeline: the grid is written once and read for the gap filling."""
    return materialize(i.grid(spark, sf, frequency), "grid")


@query
def interpolate_linear(spark, sf):
    return gaps.interpolate(_stored_grid(spark, sf), i.SENSORS, TIME, ["station"], step_seconds=3600)


@query
def interpolate_limited(spark, sf):
    return gaps.interpolate(_stored_grid(spark, sf), i.SENSORS, TIME, ["station"], limit=2, step_seconds=3600)


@query
def interpolate_edges(spark, sf):
    """Rows without a known step: positions are counted, slices are short."""
    return gaps.interpolate(_stored_grid(spark, sf, "2h"), i.SENSORS, TIME, ["station"], limit=3, chunk_seconds=86_400)


@query
def curated_dataset(spark, sf):
    """Masks, hourly grid, gap filling, extraction and split in one go."""
    masked = masks.range_mask(i.wide_hundredths(spark, sf), i.HUNDREDTH_RANGES, TIME, ["station"])
    grid = materialize(resample.resample(masked, "1h", TIME, ["station"]), "grid")
    filled = gaps.interpolate(grid, i.SENSORS, TIME, ["station"], limit=2, step_seconds=3600)
    period = extract.date_range(filled, TIME, "2024-01-03", "2024-01-28")
    names = {"station": "station", TIME: TIME, "click": "Ta_WT", "view": "RH", "error": "E", "purchase": "P", "signup": "S", "click_interpolated": "filled"}
    return extract.split_columns_by_date(extract.select_rename(period, names), TIME, "2024-01-16", ("WT",))


@query
def resample_unkeyed(spark, sf):
    return resample.resample(i.wide_hundredths(spark, sf).drop("station"), "5min", TIME)


@query
def odd_range_mask(spark, sf):
    """As below: a NULL key is a key like any other, and NaN is a missing reading."""
    return masks.range_mask(i.odd_wide(spark, sf), i.RANGES, TIME, ["event_id", "station"])


@query
def odd_range_stats(spark, sf):
    stats = masks.range_stats(i.odd_wide(spark, sf), i.RANGES, TIME, ["station"], ["event_id"])
    stats = stats.select("station", "sensor", "variable_type", "initial_count", "flagged_count", "flagged_percentage", "bounds")
    return rounded(stats, "flagged_percentage")


@query
def odd_resample_mean(spark, sf):
    return resample.resample(i.odd_hundredths(spark, sf), "1h", TIME, ["station"])


@query
def odd_resample_seven_hours(spark, sf):
    return resample.resample(i.odd_hundredths(spark, sf), "7h", TIME, ["station"])


@query
def odd_interpolate_edges(spark, sf):
    grid = materialize(resample.resample(i.odd_hundredths(spark, sf), "2h", TIME, ["station"]), "grid")
    return gaps.interpolate(grid, i.SENSORS, TIME, ["station"], limit=3, chunk_seconds=86_400)


@query
def odd_temporal_consistency(spark, sf):
    report = series.temporal_consistency(i.odd_wide(spark, sf), TIME, ["station"], expected_seconds=1800)
    return rounded(report, "median_interval_s", "min_interval_s", "max_interval_s")


@query
def odd_missing_ratio(spark, sf):
    return rounded(integrity.missing_ratio(i.odd_wide(spark, sf), i.SENSORS, ["station"]), "missing_ratio")


@query
def odd_constant_mask(spark, sf):
    rows = i.shipments(spark, sf).withColumn("station", F.when(F.col("station") != "O", F.col("station")))
    return constant.constant_mask(rows, constant.constant_days(rows, i.CONSTANT_RULES, TIME, ["station"]), TIME, ["station"])


@query
def interpolation_stats(spark, sf):
    filled = gaps.interpolate(_stored_grid(spark, sf), i.SENSORS, TIME, ["station"], limit=2, step_seconds=3600)
    return gaps.interpolation_stats(filled, i.SENSORS, ["station"])


# --- integrity -----------------------------------------------------------------------------------


@query
def dedupe_keep_first(spark, sf):
    rest = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    rows = i.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *rest)
    return integrity.dedupe_keep_first(rows, ["l_orderkey", "l_linenumber"], [F.col(n) for n in rest])


@query
def duplicate_count(spark, sf):
    return integrity.duplicate_count(i.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def missing_ratio(spark, sf):
    return rounded(integrity.missing_ratio(i.wide(spark, sf), i.SENSORS, ["station"]), "missing_ratio")


@query
def value_range_counts(spark, sf):
    ranges = {"click": (5.0, 200.0), "error": (0.0, 150.0), "view": (-1.0, 1e6), "absent": (0.0, 1.0)}
    return integrity.value_range_counts(i.wide(spark, sf), ranges, ["station"])


@query
def table_summary(spark, sf):
    return integrity.table_summary(i.wide(spark, sf), TIME, ["station"])


@query
def temporal_consistency(spark, sf):
    report = series.temporal_consistency(i.wide(spark, sf), TIME, ["station"], expected_seconds=1800)
    return rounded(report, "median_interval_s", "min_interval_s", "max_interval_s")


@query
def temporal_gaps(spark, sf):
    return rounded(series.temporal_gaps(i.wide(spark, sf), TIME, 1800, ["station"]), "duration_s")


# --- missing rates -------------------------------------------------------------------------------


@query
def missing_rate_monthly(spark, sf):
    return rounded(missing.monthly_missing_rate(i.orders_wide(spark, sf), TIME), "missing_rate")


@query
def missing_rate_daylight(spark, sf):
    return rounded(missing.monthly_missing_rate(i.wide(spark, sf), TIME, i.SENSORS, (6, 18)), "missing_rate")


@query
def missing_rate_matrix(spark, sf):
    """The matrix over all months of the data, a row per cell."""
    rates = missing.monthly_missing_rate(i.orders_wide(spark, sf), TIME)
    ends = rates.agg(F.min("month").alias("lo"), F.max("month").alias("hi")).first()
    months = missing.calendar_months(ends["lo"], ends["hi"])
    matrix = missing.missing_rate_matrix(rates, months)
    cells = matrix.unpivot(["label", "sensor"], [c(m) for m in months], "month", "missing_percent")
    return rounded(cells, "missing_percent")


def _grouped_sensors(spark, sf):
    grid = resample.resample(i.wide(spark, sf, with_id=False).drop("station"), "10min", TIME)
    names = {"click": "a_WT_click", "error": "b_WT-to-Sed_error", "purchase": "c_SM_purchase", "signup": "d_SM_signup", "view": "e_view"}
    return extract.select_rename(grid, {TIME: TIME, **names})


@query
def missing_rate_by_group(spark, sf):
    rates = missing.missing_rate_by_group(_grouped_sensors(spark, sf), TIME, "microclimate", change_date="2024-01-16")
    return rounded(rates, "missing_rate")


@query
def missing_rate_task_summary(spark, sf):
    grid = resample.resample(i.wide(spark, sf, with_id=False).drop("station"), "10min", TIME)
    tables = {
        "first": grid.select(TIME, "click", "error"),
        "second": grid.select(TIME, "error", "view", "purchase", "signup"),
    }
    return missing.task_missing_summary(tables, "soil_moisture", TIME, (6, 18))


@query
def drop_all_null_rows(spark, sf):
    return missing.drop_all_null_rows(i.grid(spark, sf), i.SENSORS)


def _customers(spark, sf):
    return i.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("group"), F.col("c_name").alias("sensor"))


@query
def report_parts(spark, sf):
    return missing.report_parts(_customers(spark, sf))


@query
def report_part_titles(spark, sf):
    return missing.part_titles(missing.report_parts(_customers(spark, sf)), F.initcap(F.col("group")))


@query
def report_part_counts(spark, sf):
    return missing.report_part_counts(missing.report_parts(_customers(spark, sf)))


@query
def abbreviate_names(spark, sf):
    return i.sensor_names(spark, sf).select("p_partkey", abbreviate(F.col("name")).alias("short"))


@query
def wrap_names(spark, sf):
    return i.sensor_names(spark, sf).select("p_partkey", wrap(F.col("name")).alias("wrapped"))
