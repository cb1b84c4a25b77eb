"""Missing rates: by month, by sensor group, per task, and their pages in a report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationloom.columns import c, classify, nan_to_null, sensor_columns, unpivot_stats
from stationloom.errors import ValidationError
from stationloom.functions.clock import hour_in, month_text
from stationloom.functions.names import abbreviate, wrap
from stationloom.storage import materialize

# Date at which one planting was replaced, and hours counted as daylight in reports.
CHANGE_DATE = "2024-12-01"
DAYLIGHT_HOURS = (6, 18)
SENSORS_PER_PART = 10
SOIL_PATTERNS = ("SoilMoisture", "SM_")


def drop_all_null_rows(df: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """Rows with at least one reading."""
    df = nan_to_null(df)
    any_reading = F.lit(False)
    for n in sensors:
        any_reading = any_reading | c(n).isNotNull()
    return df.where(any_reading)


def monthly_missing_rate(
    df: DataFrame,
    time_col: str,
    sensors: Sequence[str] | None = None,
    hours: tuple[int, int] | None = None,
    conditions: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``(month, sensor, missing_rate)`` over the rows of each month; months without rows do not occur.

    ``conditions`` restricts the rows that count for a sensor, so that groups with different
    periods share one pass.
    """
    sensors = sensor_columns(df, [time_col]) if sensors is None else list(sensors)
    rows = nan_to_null(df).where(c(time_col).isNotNull())
    if hours is not None:
        rows = rows.where(hour_in(c(time_col), *hours))

    def missing(n: str) -> Column:
        share = c(n).isNull().cast("double")
        condition = (conditions or {}).get(n)
        return F.avg(share if condition is None else F.when(condition, share))

    months = rows.groupBy(month_text(c(time_col)).alias("month")).agg(
        *[missing(n).alias(f"_m{i}") for i, n in enumerate(sensors)]
    )
    entries = [{"sensor": F.lit(n), "missing_rate": c(f"_m{i}")} for i, n in enumerate(sensors)]
    return unpivot_stats(months, ["month"], entries).where(F.col("missing_rate").isNotNull())


def calendar_months(first: str | None, last: str | None) -> list[str]:
    """Every month from ``first`` to ``last``, as ``yyyy-MM``."""
    if first is None or last is None:
        return []
    number = lambda m: int(m[:4]) * 12 + int(m[5:7]) - 1
    return [f"{n // 12:04d}-{n % 12 + 1:02d}" for n in range(number(first), number(last) + 1)]


def missing_rate_matrix(
    rates: DataFrame, months: Sequence[str], max_length: int = 30, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per sensor (short, wrapped name), one column of percentages per month.

    ``keep`` names further columns that stay with a sensor, such as its group and page.
    """
    return (
        rates.groupBy(*[c(k) for k in keep], wrap(abbreviate(F.col("sensor")), max_length).alias("label"), "sensor")
        .pivot("month", list(months))
        .agg(F.first(F.col("missing_rate") * 100))
    )


def sensor_groups(names: Sequence[str], data_type: str) -> dict[str, str]:
    """Report group of each sensor; soil sensors come first, then the two plantings, then the rest."""

    def group(n: str) -> str:
        if data_type == "microclimate" and classify(n, {"soil": SOIL_PATTERNS}):
            return "microclimate_soil_moisture"
        if "_WT-to-Sed" in n:
            return f"{data_type}_wt_to_sed"
        return f"{data_type}_wt" if "_WT" in n else f"{data_type}_other"

    if data_type not in ("microclimate", "power"):
        return {n: data_type for n in names}
    # a name holding both marks belongs to the changed planting
    return {n: group(n) for n in names}


def group_title(group: str, data_type: str) -> str:
    kind = data_type.replace("_", " ").title()
    # Titles of the groups of a report.
    titles = {
        f"{data_type}_wt": f"{kind} (WT - Before Dec 2024)",
        f"{data_type}_wt_to_sed": f"{kind} (WT-to-Sed - After Dec 2024)",
        f"{data_type}_other": f"{kind} (Other)",
        f"{data_type}_soil_moisture": f"{kind} (Soil Moisture)",
    }
    return titles.get(group, kind)


def group_conditions(groups: Mapping[str, str], time_col: str, change_date: str = CHANGE_DATE) -> dict[str, Column]:
    """Rows that count for a sensor: before or since the change for a planting, rows with any reading for soil."""
    at = F.lit(change_date).cast("timestamp_ntz")
    conditions: dict[str, Column] = {}
    for n, group in groups.items():
        if "wt_to_sed" in group:
            conditions[n] = c(time_col) >= at
        elif "wt" in group:
            conditions[n] = c(time_col) < at
        elif "soil_moisture" in group:
            any_reading = F.lit(False)
            for other, g in groups.items():
                if g == group:
                    any_reading = any_reading | c(other).isNotNull()
            conditions[n] = any_reading
    return conditions


def missing_rate_by_group(
    df: DataFrame,
    time_col: str,
    data_type: str,
    hours: tuple[int, int] | None = DAYLIGHT_HOURS,
    change_date: str = CHANGE_DATE,
    per_part: int | None = None,
) -> DataFrame:
    """``(data_type, group, month, sensor, missing_rate)`` for all groups of a table in one pass.

    With ``per_part`` also the page of each sensor and its title; sensors fill the pages of their
    group in the order of the columns.
    """
    groups = sensor_groups(sensor_columns(df, [time_col]), data_type)
    rates = monthly_missing_rate(
        df, time_col, list(groups), hours, group_conditions(groups, time_col, change_date)
    )
    lookup = lambda of: F.create_map(*[F.lit(x) for pair in of.items() for x in pair])[F.col("sensor")]
    grouped = rates.select(
        F.lit(data_type).alias("data_type"), lookup(groups).alias("group"), "month", "sensor", "missing_rate"
    )
    if per_part is None:
        return grouped
    pages = column_pages(groups, per_part)
    return grouped.select(
        "*",
        lookup({n: part for n, (part, _) in pages.items()}).alias("part"),
        lookup({n: parts for n, (_, parts) in pages.items()}).alias("parts"),
        lookup({n: page_title(group_title(groups[n], data_type), *page) for n, page in pages.items()}).alias("title"),
    )


@dataclass(frozen=True)
class LongTables:
    """Many tables of one kind as one, whatever their columns.

    ``rows`` has a row per table and time, with ``cells``, an array of (sensor, value); ``sensors`` has (table, place,
    sensor), all columns of all tables, also those without a reading. Sensor names carry their table.
    """

    rows: DataFrame
    sensors: DataFrame

    def readings(self) -> DataFrame:
        """(table, time, sensor, value) of every cell."""
        return self.rows.select("table", "time", F.explode("cells").alias("x")).select("table", "time", "x.sensor", "x.value")


def group_expr(sensor: Column, data_type: str) -> Column:
    """:func:`sensor_groups` of a column of names."""
    if data_type not in ("microclimate", "power"):
        return F.lit(data_type)
    soil = F.lit(False)
    for p in SOIL_PATTERNS if data_type == "microclimate" else ():
        soil = soil | F.contains(sensor, F.lit(p))
    return (
        F.when(soil, "microclimate_soil_moisture").when(F.contains(sensor, F.lit("_WT-to-Sed")), f"{data_type}_wt_to_sed")
        .when(F.contains(sensor, F.lit("_WT")), f"{data_type}_wt").otherwise(f"{data_type}_other")
    )


# Which times count for the sensors of a group.
ALL, BEFORE, SINCE, SOIL = "all", "before", "since", "soil"


def _basis(group: Column) -> Column:
    return (
        F.when(F.contains(group, F.lit("wt_to_sed")), SINCE).when(F.contains(group, F.lit("wt")), BEFORE)
        .when(F.contains(group, F.lit("soil_moisture")), SOIL).otherwise(ALL)
    )


def long_missing_rates(
    tables: LongTables, data_type: str, hours: tuple[int, int] | None = DAYLIGHT_HOURS, change_date: str = CHANGE_DATE
) -> DataFrame:
    """``(data_type, group, month, sensor, missing_rate)`` over the times that any of the tables has, without aligning them.

    A sensor's readings are counted by month, and so are the times of all tables together that count for its group; what is not
    counted is missing. The width of the plan does not depend on how many tables or columns there are. A time that a table
    holds twice is an error.
    """
    rows = tables.rows.where(F.col("time").isNotNull())
    if hours is not None:
        rows = rows.where(hour_in(F.col("time"), *hours))
    change = F.lit(change_date).cast("timestamp_ntz")
    is_soil = lambda x: group_expr(x["sensor"], data_type) == "microclimate_soil_moisture"
    soil = F.exists("cells", lambda x: is_soil(x) & x["value"].isNotNull()) if data_type == "microclimate" else F.lit(False)
    one = rows.groupBy("table", "time").agg(F.count("*").alias("n"), F.max(soil).alias("soil"))
    guard = F.when(F.col("n") > 1, F.raise_error(F.lit("duplicate times in a source")).cast("boolean")).otherwise(F.col("soil"))
    times = one.withColumn("soil", guard).groupBy("time").agg(F.max("soil").alias("soil"))
    counts = times.groupBy(month_text(F.col("time")).alias("month")).agg(
        F.count("*").alias(ALL), F.count_if(F.col("time") < change).alias(BEFORE), F.count_if(F.col("time") >= change).alias(SINCE),
        F.count_if("soil").alias(SOIL),
    )
    counts = counts.unpivot(["month"], [ALL, BEFORE, SINCE, SOIL], "basis", "n").where("n > 0")
    counts = materialize(counts, "month-times")  # a few rows a month
    cells = rows.select("time", F.explode("cells").alias("x")).where("x.value IS NOT NULL").select("time", "x.sensor")
    cells = cells.withColumn("basis", _basis(group_expr(F.col("sensor"), data_type)))
    counted = (F.col("basis").isin(ALL, SOIL)) | (F.col("basis") == F.when(F.col("time") < change, BEFORE).otherwise(SINCE))
    present = cells.where(counted).groupBy(month_text(F.col("time")).alias("month"), "sensor").agg(F.count("*").alias("present"))
    sensors = tables.sensors.select("sensor").distinct().withColumn("group", group_expr(F.col("sensor"), data_type))
    every = sensors.withColumn("basis", _basis(F.col("group"))).join(counts, "basis")
    found = every.join(present, ["month", "sensor"], "left")
    n = F.col("n").cast("double")
    return found.select(
        F.lit(data_type).alias("data_type"), "group", "month", "sensor",
        ((n - F.coalesce("present", F.lit(0).cast("long"))) / n).alias("missing_rate"),
    )


def paged_rates(rates: DataFrame, sensors: DataFrame, data_type: str, per_part: int) -> DataFrame:
    """Rates with the page of each sensor and its title; sensors fill the pages of their group in the order of tables and columns."""
    listed = sensors.withColumn("group", group_expr(F.col("sensor"), data_type))
    parts = report_parts(listed, per_part=per_part, order=["table", "place"]).drop("part_label")
    titles = {g: group_title(g, data_type) for g in (data_type, *[f"{data_type}_{x}" for x in ("wt", "wt_to_sed", "other", "soil_moisture")])}
    title = F.element_at(F.create_map(*[F.lit(x) for pair in titles.items() for x in pair]), F.col("group"))
    number = F.concat(F.lit(" (Part "), F.col("part").cast("string"), F.lit("/"), F.col("parts").cast("string"), F.lit(")"))
    title = F.concat(title, F.lit(" Missing Rate"), F.when(F.col("parts") > 1, number).otherwise(""))
    return rates.join(parts, ["group", "sensor"]).select(*rates.columns, "part", "parts", title.alias("title"))


def column_pages(groups: Mapping[str, str], per_part: int = SENSORS_PER_PART) -> dict[str, tuple[int, int]]:
    """(page, pages) of each column, for the columns of one wide table."""
    members: dict[str, list[str]] = {}
    for n, group in groups.items():
        members.setdefault(group, []).append(n)
    return {
        n: (place // per_part + 1, -(-len(names) // per_part)) for names in members.values() for place, n in enumerate(names)
    }


def page_title(title: str, part: int, parts: int) -> str:
    return f"{title} Missing Rate" + (f" (Part {part}/{parts})" if parts > 1 else "")


def file_missing_counts(
    df: DataFrame, time_col: str, sensors: Sequence[str], hours: tuple[int, int] | None = None
) -> DataFrame:
    """One row: records, cells and missing cells of a table."""
    rows = df if hours is None else df.where(hour_in(c(time_col), *hours))
    missing = F.lit(0).cast("long")
    for n in sensors:
        missing = missing + c(n).isNull().cast("long")
    return rows.agg(
        F.count("*").alias("records"),
        (F.count("*") * F.lit(len(sensors)).cast("long")).alias("cells"),
        F.coalesce(F.sum(missing), F.lit(0).cast("long")).alias("missing"),
    )


def task_missing_summary(
    tables: Mapping[str, DataFrame], data_type: str, time_col: str, hours: tuple[int, int] | None = None
) -> DataFrame:
    """One row for a task: distinct sensor names, records of its longest table, missing percentage, tables.

    A task without tables has no summary.
    """
    if not tables:
        raise ValidationError(f"no table of task {data_type!r} to summarize")
    sensors = {n for df in tables.values() for n in sensor_columns(df, [time_col])}
    counts = [file_missing_counts(df, time_col, sensor_columns(df, [time_col]), hours) for df in tables.values()]
    every = counts[0]
    for one in counts[1:]:
        every = every.unionAll(one)
    rate = F.try_divide(F.sum("missing") * F.lit(100.0), F.sum("cells"))
    return every.agg(
        F.lit(data_type.replace("_", " ").title()).alias("task"),
        F.lit(len(sensors)).cast("long").alias("total_sensors"),
        F.max("records").alias("total_records"),
        F.round(F.coalesce(rate, F.lit(0.0)), 2).alias("missing_rate_pct"),
        F.lit(len(tables)).cast("long").alias("files"),
    )


def report_parts(
    sensors: DataFrame, group: str = "group", sensor: str = "sensor", per_part: int = SENSORS_PER_PART,
    order: Sequence[str] = (),
) -> DataFrame:
    """Page of each sensor: ``(group, sensor, part, parts, part_label)``, sensors within a group by ``order``, then name.

    Positions are counted over range partitions: the distinct names are written in sorted ranges,
    a small table holds how many each range has per group, and a name's position is its place in
    the range plus what the ranges before it hold. A group of any size is spread over tasks.
    """
    by = [f"_o{i}" for i in range(len(order))]
    names = sensors.select(c(group).alias("_g"), c(sensor).alias("_s"), *[c(n).alias(o) for n, o in zip(order, by)]).distinct()
    by = [*by, "_s"]
    ranges = materialize(
        names.repartitionByRange("_g", *by).select("_g", *by, F.spark_partition_id().alias("_range")), "report-names"
    )
    in_order = Window.partitionBy("_g").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranges.groupBy("_g", "_range").agg(F.count("*").alias("_n"))
        .select(
            F.col("_g"), F.col("_range"),
            F.coalesce(F.sum("_n").over(in_order), F.lit(0).cast("long")).alias("_before"),
            F.sum("_n").over(Window.partitionBy("_g")).alias("_total"),
        )
    )
    position = F.col("_before") + F.row_number().over(Window.partitionBy("_g", "_range").orderBy(*by))
    size = F.lit(float(per_part))
    return (
        ranges.join(before, ["_g", "_range"])
        .select(
            F.col("_g").alias(group),
            F.col("_s").alias(sensor),
            F.ceil(position / size).cast("long").alias("part"),
            F.ceil(F.col("_total") / size).cast("long").alias("parts"),
        )
        .withColumn("part_label", F.concat_ws("/", F.col("part").cast("string"), F.col("parts").cast("string")))
    )


def part_titles(parts: DataFrame, title: Column, group: str = "group") -> DataFrame:
    """Title and file stem of every page; single pages carry no part number."""
    pages = parts.select(c(group).alias(group), title.alias("_title"), "part", "parts").distinct()
    several = F.col("parts") > 1
    suffix = F.concat(
        F.lit(" (Part "), F.col("part").cast("string"), F.lit("/"), F.col("parts").cast("string"), F.lit(")")
    )
    stem = F.concat(F.lower(F.replace(c(group), F.lit(" "), F.lit("_"))), F.lit("_missing_rate"))
    return pages.select(
        c(group), "part", "parts",
        F.concat(F.col("_title"), F.lit(" Missing Rate"), F.when(several, suffix).otherwise("")).alias("title"),
        F.concat(stem, F.when(several, F.concat(F.lit("_part"), F.col("part").cast("string"))).otherwise("")).alias(
            "stem"
        ),
    )


def report_part_counts(parts: DataFrame, group: str = "group") -> DataFrame:
    """Number of pages per group."""
    return parts.groupBy(c(group).alias(group)).agg(F.max("parts").alias("part_count"))
