"""Merging raw sources into one table per kind of data.

Every source is reduced to the first row of each key before it is joined or unioned further, so
duplicates never multiply. Aligning many sources on time is a union and one aggregation instead of
a chain of outer joins, each of which would shuffle again.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationloom.columns import POWER_TIME_NAMES, c, nan_to_null, time_column
from stationloom.errors import DataIntegrityError, DataProcessingError, ValidationError
from stationloom.functions.names import file_prefix, file_prefix_expr
from stationloom.functions.parse import DATE_TIME_FORMAT, parse_date_and_time, parse_number, parse_time
from stationloom.operators.integrity import dedupe_keep_first
from stationloom.operators.missing import LongTables
from stationloom.sources.files import (
    ROW_ORDER, SOURCE, TEXT, CsvTable, found_files, nth_lines, read_csv_table, read_lines, stem, with_unread,
)
from stationloom.sources.logs import parse_logs, read_station_logs, without_order
from stationloom.storage import local_table, materialize

TIME = "DateTime"

# Weather files, their value columns and the merged names.
WEATHER_FILES = {
    "Air_temperature.csv": {"Degree Celsius": "Air_Temp_C"},
    "GHI.csv": {"w/m2": "GHI_Wm2"},
    "Pressure.csv": {"Pascal": "Pressure_Pa"},
    "Relative Humidity.csv": {"%": "RelativeHumidity_pct"},
    "Visibility.csv": {"m": "Visibility_m"},
    "Wind Velocity.csv": {"m/s": "WindSpeed_ms", "Degree": "WindDirection_deg"},
}

# File name patterns of the raw sources.
LOG_PATTERN = "*.txt"
POWER_PATTERN = "Chart PV_*_Data*.csv"


def union_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows; columns are matched by name and NULL where a table lacks them."""
    whole = tables[0]
    for t in tables[1:]:
        whole = whole.unionByName(t, allowMissingColumns=True)
    return whole


def merge_devices(
    tables: Sequence[DataFrame], device: str = "device", time_col: str = TIME, order: Sequence[Column] = ()
) -> DataFrame:
    """Tables of several periods as one, the first row kept of each device and time.

    Rows of an earlier table come first; ``order`` ranks the rows within a table.
    """
    numbered = [t.withColumn("_table", F.lit(i)) for i, t in enumerate(tables)]
    return dedupe_keep_first(union_by_name(numbered), [device, time_col], [F.col("_table"), *order]).drop("_table")


def read_device_tables(
    spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.csv", device: str = "device",
    time_formats: Sequence[str] = (), columns: Sequence[str] | None = None, skip_unreadable: bool = False,
) -> tuple[DataFrame, DataFrame] | None:
    """Device sheets exported as CSV, one file per device and period, merged.

    The device is a column of that name or else the file name; rows of files that sort first win.
    The second table has the columns in the headers of each device's files, (device, column).
    """
    sheets = read_csv_table(spark, paths, pattern, True, columns, skip_unreadable)
    sheets = sheets and sheets.only(lambda names: TIME in names)
    if sheets is None:
        return None
    named = sheets.pick(lambda names: device if device in names else None)
    values = [n for n in sheets.columns if n not in (TIME, device)]
    rows = sheets.rows.select(
        *ROW_ORDER, F.coalesce(named, stem(F.col(SOURCE))).alias(device), parse_time(c(TIME), time_formats).alias(TIME),
        *[parse_number(c(n)).alias(n) for n in values],
    )
    first = without_order(dedupe_keep_first(rows, [device, TIME], [F.col(n) for n in ROW_ORDER]))
    own = lambda names: F.array(*[F.lit(n) for n in names if n not in (TIME, device)]).cast("array<string>")
    header = F.col("_header") if len(sheets.layouts) > 1 else F.lit(next(iter(sheets.layouts)))
    of = sheets.rows.select(F.coalesce(named, stem(F.col(SOURCE))).alias(device), header.alias("_h")).distinct()
    columns_of = F.lit(None).cast("array<string>")
    for text, names in sheets.layouts.items():
        columns_of = F.when(F.col("_h") == text, own(names)).otherwise(columns_of)
    return first, of.select(device, F.explode(columns_of).alias("column")).distinct()


def merge_station_logs(
    spark: SparkSession, paths: str | Sequence[str], pattern: str = LOG_PATTERN, columns: Sequence[str] | None = None,
    time_formats: Sequence[str] = (), strict: bool = False,
) -> DataFrame | None:
    """Log files of one station, the first row kept of each time; None if there are no files."""
    rows = read_station_logs(spark, paths, pattern, time_formats, columns, strict)
    return None if rows is None else without_order(dedupe_keep_first(rows, [TIME], [F.col(n) for n in ROW_ORDER]))


def station_of(source: Column, folders: Mapping[str, str]) -> Column:
    """The station in whose folder a source lies, by the path without scheme and host."""
    plain = lambda path: re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/")
    folder = F.regexp_replace(F.regexp_extract(source, r"^(.*)/[^/]*$", 1), r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    pairs = [F.lit(x) for station, path in folders.items() for x in (plain(path), station)]
    # scans report paths as URIs, in which a plus sign is just that
    return F.element_at(F.create_map(*pairs), F.try_url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))))


@dataclass(frozen=True)
class StationLogs:
    """Readings of all stations, and about their files: (device, column) in headers, audit, losses."""

    rows: DataFrame
    layout: DataFrame
    audit: DataFrame
    losses: DataFrame


def merge_all_station_logs(
    spark: SparkSession, folders: Mapping[str, str], device: str = "device", pattern: str = LOG_PATTERN,
    time_formats: Sequence[str] = (), columns: Sequence[str] | None = None, strict: bool = False,
    skip_unreadable: bool = False,
) -> StationLogs | None:
    """Log folders of any number of stations in one plan, the first row kept of each station and time.

    None if there are no files. The text is read for the heads and once more to store its lines as parsed; everything
    in the result comes from those.
    """
    lines = read_lines(spark, list(folders.values()), pattern, skip_unreadable=skip_unreadable) if folders else None
    if lines is None:
        return None
    of = station_of(F.col(SOURCE), folders).alias(device)
    parsed = parse_logs(lines, time_formats, columns, strict)
    rows = parsed.rows()
    rows = rows.select(of, *[c(n) for n in rows.columns])
    first = dedupe_keep_first(rows, [device, TIME], [F.col(n) for n in ROW_ORDER])
    layout = parsed.columns().select(of, "column").distinct()
    audit = with_unread(found_files(spark, list(folders.values()), pattern), parsed.audit())
    return StationLogs(without_order(first), layout, audit, parsed.losses())


def typed_power(table: CsvTable, time_formats: Sequence[str] = ()) -> DataFrame:
    """Text rows of power files typed; the time column of each file is detected, the time is NULL where it cannot be read."""
    found = lambda names: time_column(names, POWER_TIME_NAMES, names[0])
    times = {TIME, *[found(names) for names in table.layouts.values()]}
    return table.rows.select(
        *[c(n) for n in table.rows.columns if n not in table.columns and n != "_header"],
        parse_time(table.pick(found), time_formats).alias(TIME),
        *[parse_number(c(n)).alias(n) for n in table.columns if n not in times],
    )


def power_rows(table: CsvTable, time_formats: Sequence[str] = ()) -> DataFrame:
    """:func:`typed_power` without the rows that have no time."""
    return typed_power(table, time_formats).where(F.col(TIME).isNotNull())


@dataclass(frozen=True)
class MergedFiles:
    """Merged rows, and what the merge left out of each file: (source, data_lines, invalid_time, duplicate_times).

    A copy of a time counts for the file it is in, also where the row that is kept is in another.
    """

    rows: DataFrame
    losses: DataFrame


def file_losses(typed: DataFrame, kept: DataFrame) -> DataFrame:
    """(source, data_lines, invalid_time, duplicate_times) from rows with their file, and those of them that are kept."""
    lines = typed.groupBy(c(SOURCE)).agg(F.count("*").alias("data_lines"), F.count_if(F.col(TIME).isNull()).alias("invalid_time"))
    stay = kept.groupBy(c(SOURCE).alias("_of")).agg(F.count("*").alias("kept"))
    copies = F.col("data_lines") - F.col("invalid_time") - F.coalesce("kept", F.lit(0))
    return lines.join(stay, F.col(SOURCE) == F.col("_of"), "left").select(
        F.col(SOURCE).alias("source"), "data_lines", "invalid_time", copies.alias("duplicate_times")
    )


def merge_power_files(
    spark: SparkSession, paths: str | Sequence[str], pattern: str = POWER_PATTERN, time_formats: Sequence[str] = (),
    columns: Sequence[str] | None = None, skip_unreadable: bool = False,
) -> MergedFiles:
    """Power files, the first row kept of each time. The rows are stored once as parsed; merge and losses come from there."""
    table = read_csv_table(spark, paths, pattern, columns=columns, skip_unreadable=skip_unreadable)
    if table is None:
        raise ValidationError(f"no power file {pattern!r} with a header found in {paths}")
    typed = materialize(typed_power(table, time_formats), "power-lines")
    first = dedupe_keep_first(typed.where(F.col(TIME).isNotNull()), [TIME], [F.col(n) for n in ROW_ORDER])
    return MergedFiles(without_order(first), file_losses(typed, first))


def merge_power(
    spark: SparkSession, paths: str | Sequence[str], pattern: str = POWER_PATTERN, time_formats: Sequence[str] = (),
    columns: Sequence[str] | None = None, skip_unreadable: bool = False,
) -> DataFrame:
    return merge_power_files(spark, paths, pattern, time_formats, columns, skip_unreadable).rows


def align_on_time(sources: Sequence[DataFrame], keys: Sequence[str] = (TIME,)) -> DataFrame:
    """Full outer alignment of tables with distinct columns: one row per key, all columns.

    A key that a source holds twice is an error, raised when the result is computed.
    """
    names = [n for s in sources for n in s.columns if n not in keys]
    if len(set(names)) != len(names):
        raise ValidationError("sources to align must not share column names")
    marked = union_by_name([s.withColumn("_table", F.lit(i)) for i, s in enumerate(sources)])
    counts = [F.count_if(F.col("_table") == i).alias(f"_n{i}") for i in range(len(sources))]
    grouped = marked.groupBy(*[c(k) for k in keys]).agg(
        *counts, *[F.first(c(n), ignorenulls=True).alias(n) for n in names]
    )
    most = F.greatest(F.lit(0), *[F.col(f"_n{i}") for i in range(len(sources))])
    guard = lambda v: F.when(most > 1, F.raise_error(F.lit("duplicate times in a source"))).otherwise(v)
    return grouped.select(*[c(k) for k in keys], *[guard(c(n)).alias(n) for n in names])


def merge_full_outer(sources: Sequence[tuple[DataFrame, Sequence[str]]], key: str = TIME) -> DataFrame:
    """Outer join of (table, its row-order columns) on the time, the first row kept of each time of a source.

    All sources are reduced in one window over (source, time) and aligned in one aggregation. The
    row-order columns of all sources are alike in number and type and do not reach the result.
    """
    depth = {len(order) for _, order in sources}
    if len(depth) != 1:
        raise ValidationError("every source needs the same number of row-order columns")
    places = [f"_order{k}" for k in range(depth.pop())]
    tagged, values = [], []
    for i, (df, order) in enumerate(sources):
        own = [n for n in df.columns if n != key and n not in order]
        values += own
        ranks = [c(n).alias(place) for n, place in zip(order, places)]
        tagged.append(df.select(F.lit(i).alias("_table"), c(key), *ranks, *[c(n) for n in own]))
    if len(set(values)) != len(values):
        raise ValidationError("sources to align must not share column names")
    first = dedupe_keep_first(union_by_name(tagged), ["_table", key], [F.col(p) for p in places])
    return first.groupBy(c(key)).agg(*[F.first(c(n), ignorenulls=True).alias(n) for n in values])


def typed_weather(rows: DataFrame, columns: Mapping[str, str], time_formats: Sequence[str] = ()) -> DataFrame | None:
    """Date and Time put together, value columns renamed; the time is NULL where it cannot be read.

    None if the file lacks Date, Time or a value column. ``time_formats`` are tried after the usual one, on both
    columns with a blank between.
    """
    if not {"Date", "Time", *columns} <= set(rows.columns):
        return None
    order = [n for n in ROW_ORDER if n in rows.columns]
    times = [parse_date_and_time(c("Date"), c("Time"), f) for f in (DATE_TIME_FORMAT, *time_formats)]
    return rows.select(
        *order, F.coalesce(*times).alias(TIME), *[parse_number(c(old)).alias(new) for old, new in columns.items()],
    )


def weather_rows(rows: DataFrame, columns: Mapping[str, str], time_formats: Sequence[str] = ()) -> DataFrame | None:
    """:func:`typed_weather` without the rows that have no time."""
    typed = typed_weather(rows, columns, time_formats)
    return None if typed is None else typed.where(F.col(TIME).isNotNull())


def merge_weather_files(
    spark: SparkSession, folder: str, files: Mapping[str, Mapping[str, str]] = WEATHER_FILES, time_formats: Sequence[str] = (),
    known: Mapping[str, Sequence[str]] | None = None, skip_unreadable: bool = False,
) -> MergedFiles:
    """Weather files that exist and have their columns, aligned on time, the first row kept of each time of a file.

    ``known`` gives the columns of files by name, which saves the look at their headers. The rows of all files are stored
    once as parsed; the merge, one window and one aggregation, and the losses come from there.
    """
    parts, values = [], []
    for name, columns in files.items():
        table = read_csv_table(spark, folder, name, columns=(known or {}).get(name), skip_unreadable=skip_unreadable)
        typed = typed_weather(table.rows, columns, time_formats) if table else None
        if typed is not None:
            parts.append(typed.withColumn("_table", F.lit(len(parts))))
            values += columns.values()
    if not parts:
        raise DataProcessingError(f"no weather file could be read from {folder}")
    typed = materialize(union_by_name(parts), "weather-lines")
    first = dedupe_keep_first(typed.where(F.col(TIME).isNotNull()), ["_table", TIME], [F.col(n) for n in ROW_ORDER])
    aligned = first.groupBy(c(TIME)).agg(*[F.first(c(n), ignorenulls=True).alias(n) for n in values])
    return MergedFiles(aligned, file_losses(typed, first))


def merge_weather(
    spark: SparkSession, folder: str, files: Mapping[str, Mapping[str, str]] = WEATHER_FILES, time_formats: Sequence[str] = (),
    known: Mapping[str, Sequence[str]] | None = None, skip_unreadable: bool = False,
) -> DataFrame:
    return merge_weather_files(spark, folder, files, time_formats, known, skip_unreadable).rows


def prefixed(df: DataFrame, table: str, keys: Sequence[str] = (TIME,)) -> DataFrame:
    """Sensor columns named after their table."""
    prefix = file_prefix(table)
    return df.select(*[c(k) for k in keys], *[c(n).alias(f"{prefix}_{n}") for n in df.columns if n not in keys])


def combine_prefixed(tables: Mapping[str, DataFrame], keys: Sequence[str] = (TIME,)) -> DataFrame:
    """Tables of one kind side by side on time; a time that a table holds twice is an error."""
    if not tables:
        raise DataIntegrityError("no table to combine")
    return align_on_time([prefixed(df, name, keys) for name, df in sorted(tables.items())], keys)


def long_tables(tables: Mapping[str, DataFrame], time_col: str = TIME) -> LongTables:
    """Tables with columns of their own as long ones, sensors named after their table."""
    if not tables:
        raise DataIntegrityError("no table to combine")
    parts, listed = [], []
    for name, df in sorted(tables.items()):
        df, prefix = nan_to_null(df), file_prefix(name)
        own = {n: f"{prefix}_{n}" for n in df.columns if n != time_col}
        cells = F.array(*[F.struct(F.lit(s).alias("sensor"), c(n).cast("double").alias("value")) for n, s in own.items()])
        cells = cells.cast("array<struct<sensor: string, value: double>>")
        parts.append(df.select(F.lit(name).alias("table"), c(time_col).alias("time"), cells.alias("cells")))
        listed += [(name, i, s) for i, s in enumerate(own.values())]
    sensors = local_table(parts[0].sparkSession, listed, "table string, place int, sensor string")
    return LongTables(union_by_name(parts), sensors)


def csv_fields(text: Column) -> Column:
    """The fields of a CSV line, also quoted ones."""
    bare = lambda x: F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))
    found = F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(r',("(?:[^"]|"")*+"|[^,]*+)'), F.lit(1))
    quoted = F.transform(found, lambda x: F.when(x.startswith('"'), bare(x)).otherwise(x))
    return F.when(F.contains(text, F.lit('"')), quoted).otherwise(F.split(text, ",", -1))


def read_long(
    spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.csv", time_col: str = TIME, recursive: bool = False,
    table: Column | None = None, skip_unreadable: bool = False,
) -> LongTables | None:
    """CSV tables as the sinks write them, any number of files with any columns, in one scan; None if there are none.

    The lines are stored once; the first one of a file is its header, joined to its other lines, which are cut in cells by it.
    No name of a file or column comes to the driver. Files without the time column are left out. ``table`` gives the
    table of a file by its path (``_source``), the file name without extension if it is not given.
    """
    lines = read_lines(spark, paths, pattern, recursive, skip_unreadable)
    if lines is None:
        return None
    table = stem(F.col(SOURCE)) if table is None else table
    lines = materialize(lines.where(F.trim(TEXT) != "").select(*ROW_ORDER, table.alias("table"), TEXT), "csv-lines")
    heads = nth_lines(lines, 1).select(SOURCE, F.col(TEXT).alias("_header"), csv_fields(F.col(TEXT)).alias("_names"))
    heads = materialize(heads.where(F.array_contains("_names", time_col)), "csv-heads")
    fields = csv_fields(F.col(TEXT))
    sensor = lambda name: F.concat(file_prefix_expr(F.col("table")), F.lit("_"), name)
    rows = lines.join(heads, SOURCE).where(F.col(TEXT) != F.col("_header")).withColumn("_fields", fields)
    numbered = F.transform("_names", lambda n, i: F.struct(n.alias("n"), i.alias("i")))
    cells = F.transform(
        F.filter(numbered, lambda x: x["n"] != time_col),
        lambda x: F.struct(sensor(x["n"]).alias("sensor"), F.nullif(parse_number(F.get("_fields", x["i"])), F.lit(float("nan"))).alias("value")),
    )
    time = parse_time(F.get("_fields", F.array_position("_names", time_col).cast("int") - 1))
    tables = lines.select(SOURCE, "table").distinct().join(heads, SOURCE)
    names = tables.select("table", F.posexplode("_names").alias("place", "name")).where(F.col("name") != time_col)
    sensors = names.groupBy("table", "name").agg(F.min("place").alias("place"))
    return LongTables(
        rows.select("table", time.alias("time"), cells.alias("cells")),
        materialize(sensors.select("table", "place", sensor(F.col("name")).alias("sensor")), "csv-sensors"),
    )


def read_typed_csv(
    spark: SparkSession, paths: str | Sequence[str], time_col: str = TIME, columns: Sequence[str] | None = None,
    pattern: str = "*.csv",
) -> DataFrame:
    """A CSV table as the sinks write it: a time column and numbers."""
    table = read_csv_table(spark, paths, pattern, columns=columns)
    if table is None:
        raise ValidationError(f"no CSV table at {paths}")
    return table.rows.select(
        *[(parse_time(c(n)) if n == time_col else parse_number(c(n))).alias(n) for n in table.columns]
    )
