"""The given tables seen as sensor tables, with the rules the queries apply to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationloom.operators.resample import resample
from stationloom.rules import ConstantRule, DayNight, FailureWindow, RangeRule
from stationloom.sources.files import BLOCK, LINE, SOURCE, TEXT

SENSORS = ("click", "error", "purchase", "signup", "view")
FLAGS = ("A", "N", "R")
STATUSES = ("F", "O", "P")

RANGES = [
    RangeRule("click_rate", 5, 200, ("click",), "u"),
    RangeRule("error_rate", 0, 150, ("err",), "u"),
    RangeRule("purchase_rate", 1, 100, ("purchase",), "u"),
    RangeRule("signup_rate", 0, 1000, ("signup",), "u"),
]
HUNDREDTH_RANGES = [RangeRule("click_rate", 500, 20000, ("click",)), RangeRule("view_rate", 0, 15000, ("view",))]
TIMED_RANGES = [
    RangeRule("view_rate", 0, 160, ("view",), "u", day_night=DayNight(7, 17, 10, 0)),
    RangeRule("click_rate", 2, 200, ("click",), "u", day_night=DayNight(6, 18, 8, 4, 120)),
    RangeRule("error_rate", 0, 150, ("error",), "u"),
]
WINDOWS = [
    FailureWindow("s3", "2024-01-05", "2024-01-09", ("cl", "si")),
    FailureWindow("s7", "2024-01-10", "2024-01-20", ("view", "vi", "error")),
    FailureWindow("s99", "2024-01-10", "2024-01-20", ("view",)),
]
# eight windows for each of ten stations, long enough a list to be joined
MANY_WINDOWS = [
    FailureWindow(f"s{s}", f"2024-01-{1 + 3 * i:02d}", f"2024-01-{2 + 3 * i:02d}", ("click", "view") if s % 2 else ("e",))
    for s in range(10)
    for i in range(8)
]
CONSTANT_RULES = [
    ConstantRule("one_day", ("q_A",), 1),
    ConstantRule("three_days", ("q_N",), 3),
    ConstantRule("seven_days", ("q_R",), 7),
]
SHIP_RANGES = [RangeRule("quantity", 2, 48, ("q_",), "pcs")]
SHIP_WINDOWS = [
    FailureWindow("F", "1996-03-01", "1996-06-01", ("q_A", "q_N")),
    FailureWindow("O", "1999-01-01", "1999-12-31", ("q_",)),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long: one reading per row."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("user_id") % 10).alias("station"),
        F.col("ts").alias("DateTime"),
        F.col("event_type").alias("sensor"),
        "value",
    )


def wide(spark: SparkSession, sf_dir: str, with_id: bool = True) -> DataFrame:
    """One row per event, one column per sensor."""
    r = readings(spark, sf_dir)
    return r.select(
        *(["event_id"] if with_id else []),
        "station", "DateTime", *[F.when(F.col("sensor") == s, F.col("value")).alias(s) for s in SENSORS],
    )


def wide_hundredths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`wide` without the id, in whole hundredths: sums are exact in any order, so means compare bit by bit."""
    w = wide(spark, sf_dir, with_id=False)
    return w.select("station", "DateTime", *[hundredths(F.col(s)).alias(s) for s in SENSORS])


def odd_wide(spark: SparkSession, sf_dir: str, with_id: bool = True) -> DataFrame:
    """:func:`wide` with station 3 unnamed, and NaN in place of some readings."""
    w = wide(spark, sf_dir)
    nan = lambda n: F.when(F.col(n).isNotNull() & (F.col("event_id") % 71 == 5), float("nan")).otherwise(F.col(n))
    station = F.when(F.col("station") != 3, F.col("station"))
    return w.select(*(["event_id"] if with_id else []), station.alias("station"), "DateTime", *[nan(s).alias(s) for s in SENSORS])


def odd_hundredths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`wide_hundredths` with station 3 unnamed, and NaN in place of some readings."""
    w = odd_wide(spark, sf_dir, with_id=False)
    return w.select("station", "DateTime", *[hundredths(F.col(s)).alias(s) for s in SENSORS])


def hundredths(value: Column) -> Column:
    return F.round(value * 100)


def station_key() -> Column:
    return F.concat(F.lit("s"), F.col("station").cast("string"))


def grid(spark: SparkSession, sf_dir: str, frequency: str = "1h") -> DataFrame:
    """Regular grid per station with many empty bins."""
    return resample(wide_hundredths(spark, sf_dir), frequency, "DateTime", ["station"])


def minute_source(spark: SparkSession, sf_dir: str, sensor: str) -> DataFrame:
    """One sensor as a source of its own; the times repeat within a minute."""
    r = readings(spark, sf_dir).where(F.col("sensor") == sensor)
    return r.select(
        F.date_trunc("minute", "DateTime").cast("timestamp_ntz").alias("DateTime"), "event_id", F.col("value").alias(sensor)
    )


def hourly_source(spark: SparkSession, sf_dir: str, sensor: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Hourly mean and maximum of one sensor, only for hours that have readings."""
    r = readings(spark, sf_dir).where(F.col("sensor") == sensor)
    hour = F.date_trunc("hour", "DateTime").cast("timestamp_ntz").alias("DateTime")
    return r.groupBy(*keys, hour).agg(F.avg(hundredths(F.col("value"))).alias("mean"), F.max("value").alias("max"))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series with stretches of seven constant days."""
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date"))
    value = F.when(day % 11 < 7, F.lit(20.0)).otherwise(F.col("l_quantity"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linestatus").alias("station"),
        F.col("l_shipdate").alias("DateTime"),
        *[F.when(F.col("l_returnflag") == f, value).alias(f"q_{f}") for f in FLAGS],
    )


def orders_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("DateTime"),
        *[F.when(F.col("o_orderstatus") == s, F.col("o_totalprice")).alias(s) for s in STATUSES],
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written out as station logs: two head lines per station, two layouts, some broken lines.

    Board lines of odd stations are as wide as their header; two more sources have no usable header.
    """
    e = table(spark, sf_dir, "events").withColumn("station", F.col("user_id") % 10)
    source = F.concat(F.lit("log/"), F.col("station").cast("string"), F.lit(".txt"))
    ts, value, user = (F.col(n).cast("string") for n in ("ts", "value", "user_id"))
    sep, comma = F.lit(";"), F.lit(",")
    line = (
        F.when(F.col("value") < 1, F.concat(ts, sep, value, sep))  # a field too few
        .when(F.col("value") > 200, F.concat(F.lit("not a time"), sep, value, comma, user, F.lit(";;")))
        .when(F.col("value") > 150, F.concat(F.lit("  "), ts, sep, F.lit("n/a"), comma, user, F.lit(";;; ")))
        .otherwise(F.concat(ts, sep, value, comma, user, sep))
    )
    data = e.select(source.alias(SOURCE), F.lit(0).cast("long").alias(BLOCK), (F.col("event_id") + 2).alias(LINE), line.alias(TEXT))
    head = F.array(
        F.concat(F.lit("BoardID:"), F.col("station").cast("string"), F.when(F.col("station") % 2 == 1, ";fw,2;").otherwise("")),
        F.when(F.col("station") < 5, "DateTime;Temp1,User1;").otherwise("DateTime;; Hum1 ,User1;;"),
    )
    heads = e.select(source.alias(SOURCE), "station").distinct().select(
        SOURCE, F.lit(0).cast("long").alias(BLOCK), F.posexplode(head).alias(LINE, TEXT)
    )
    broken = [("log/short.txt", 0, 0, "BoardID:77"), ("log/wrong.txt", 0, 0, "BoardID:78"), ("log/wrong.txt", 0, 1, "Time;a"),
              ("log/wrong.txt", 0, 2, "2024-01-01 00:00:00;1")]
    more = spark.createDataFrame(broken, f"{SOURCE} string, {BLOCK} long, {LINE} long, {TEXT} string")
    return data.unionAll(heads.select(SOURCE, BLOCK, F.col(LINE).cast("long"), TEXT)).unionAll(more)


def sensor_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long sensor names put together from part attributes."""
    p = table(spark, sf_dir, "part")
    kind = F.when(F.col("p_size") < 10, "Temperature").when(F.col("p_size") < 20, "WindSpeed_WindSpeed").when(
        F.col("p_size") < 30, "Humidity_RH"
    ).otherwise("Radiation")
    height = F.when(F.col("p_size") % 3 == 0, "_180cm").when(F.col("p_size") % 3 == 1, "_050cm").otherwise("__")
    return p.select(
        "p_partkey",
        F.concat(
            kind, height, F.lit("_PVHgt_090cm_"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), F.col("p_type"),
            F.lit("_"), F.col("p_type"), F.lit("_(No Change)"),
        ).alias("name"),
    )
