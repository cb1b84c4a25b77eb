"""Delimited station logs.

Line 1 names the board, line 2 the columns (groups separated by ``;``, names inside a group by
``,``), the rest are readings. The files are read line by line and split over tasks like any text;
the two head lines of each file are found first, from the first pieces of the files, and joined to
its lines. :func:`parse_logs` stores every line as parsed, with the reason where it is no reading, so that rows, layout,
audit and losses of a merge come from one read of the text after that for the heads.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationloom.columns import c
from stationloom.errors import DataParsingError
from stationloom.functions.parse import parse_number, parse_time
from stationloom.sources.files import BLOCK, LINE, ROW_ORDER, SOURCE, TEXT, read_lines
from stationloom.storage import materialize

TIME = "DateTime"
HEADER_LINE = 2
BLANKS = " \t\r\n\v\f"


def _stripped(text: Column) -> Column:
    """Without blanks around it and without any trailing ``;``."""
    return F.rtrim(F.trim(text, F.lit(BLANKS)), F.lit(";"))


def _names(header: Column) -> Column:
    groups = F.filter(F.split(header, ";", -1), lambda g: F.trim(g) != "")
    return F.transform(F.split(F.array_join(groups, ","), ",", -1), lambda n: F.trim(n))


def log_heads(lines: DataFrame) -> DataFrame:
    """``(_source, _board, _header, _names, status)``: the first two lines of every source and what they are good for."""
    first = Window.partitionBy(SOURCE).orderBy(LINE)
    head = lines.where(F.col(BLOCK) == 0).withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= HEADER_LINE)
    heads = head.groupBy(SOURCE).agg(
        F.max(F.when(F.col("_n") == 1, F.col(TEXT))).alias("_board"),
        F.max(F.when(F.col("_n") == HEADER_LINE, F.col(TEXT))).alias("_header"),
    )
    heads = heads.withColumn("_names", _names(_stripped(F.col("_header"))))
    status = (
        F.when(F.col("_header").isNull() | (_stripped(F.col("_header")) == ""), "no header")
        .when(~F.array_contains("_names", TIME), f"header without {TIME}")
        .when(F.size(F.array_distinct("_names")) < F.size("_names"), "repeated column")
        .otherwise("ok")
    )
    return heads.withColumn("status", status)


def _usable(heads: DataFrame, strict: bool) -> list[list[str]]:
    """The distinct layouts of usable heads; an error if there are none, or if ``strict`` and one is of no use."""
    bad = heads.where("status <> 'ok'").orderBy(SOURCE).limit(5).collect()
    layouts = sorted(r["_names"] for r in heads.where("status = 'ok'").select("_names").distinct().collect())  # a few header texts
    if not layouts or (strict and bad):
        reasons = "; ".join(f"{r[SOURCE]}: {r['status']}" for r in bad)
        raise DataParsingError(f"log files without a usable header: {reasons}" if bad else "no source has a header line")
    return layouts


# Why a line of a source is no reading; OK and NO_TIME have the fields of one.
OK, NO_TIME, WRONG_WIDTH, HEAD, REPEATED_HEAD, BLANK, NO_HEADER = (
    "ok", "no time", "wrong width", "head", "repeated head", "blank", "no usable header",
)


def _parsed(
    lines: DataFrame, layouts: Sequence[Sequence[str]], heads: DataFrame | None, time_formats: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """Every line with its ``reason`` and, if it has the fields of a reading, its time and numbers; the sensor names.

    Without ``heads`` all sources have the one layout, and lines of the head are not yet told apart.
    """
    clean = _stripped(F.col(TEXT))
    rows = lines.withColumn("_clean", clean).withColumn("_fields", F.split("_clean", "[;,]", -1))
    if heads is None:
        rows = rows.withColumn("_names", F.array(*[F.lit(n) for n in layouts[0]]))
        is_head = F.lit(False)
    else:
        # one row per source; its files give Catalyst the size to choose the join by
        rows = rows.join(heads.where("status = 'ok'").select(SOURCE, "_board", "_header", "_names"), SOURCE, "left")
        is_head = (F.col(TEXT) == F.col("_board")) | (F.col(TEXT) == F.col("_header"))
    if len(layouts) == 1:
        position = {n: F.lit(i) for i, n in enumerate(layouts[0])}
    else:
        position = {
            n: F.array_position("_names", n).cast("int") - 1 for n in dict.fromkeys(n for names in layouts for n in names)
        }
    field = lambda n: F.get("_fields", position[n])
    sensors = [n for n in position if n != TIME]
    time = parse_time(field(TIME), time_formats)
    reason = (
        F.when(F.col("_names").isNull(), NO_HEADER).when(F.col("_clean") == "", BLANK).when(is_head, HEAD)
        # a file put together from several has head lines inside
        .when(F.trim(field(TIME)) == TIME, REPEATED_HEAD).when(F.size("_fields") != F.size("_names"), WRONG_WIDTH)
        .when(time.isNull(), NO_TIME).otherwise(OK)
    )
    fits = F.col("reason").isin(OK, NO_TIME)
    out = rows.withColumn("reason", reason).select(
        *ROW_ORDER, "reason", F.when(F.col("reason") != OK, F.col(TEXT)).alias(TEXT), F.when(fits, time).alias(TIME),
        *[F.when(fits, parse_number(field(n))).alias(n) for n in sensors],
    )
    return out, sensors


@dataclass(frozen=True)
class ParsedLogs:
    """Every line of the sources as it was parsed, stored once, and the heads: what is asked of the logs comes from here.

    ``lines`` has the line order, ``reason``, the text of what is no reading, ``DateTime`` and a double per sensor.
    """

    lines: DataFrame
    heads: DataFrame
    sensors: list[str]

    def rows(self) -> DataFrame:
        """The readings, also those without a time."""
        kept = self.lines.where(F.col("reason").isin(OK, NO_TIME))
        return kept.select(*ROW_ORDER, TIME, *[c(n) for n in self.sensors])

    def columns(self) -> DataFrame:
        """``(_source, column)`` of usable headers."""
        named = self.heads.where("status = 'ok'").select(SOURCE, F.explode("_names").alias("column"))
        return named.where(F.col("column") != TIME)

    def audit(self) -> DataFrame:
        """``(source, lines, status)`` of every source that has a line."""
        counted = self.lines.groupBy(SOURCE).agg(F.count("*").alias("lines"))
        return counted.join(self.heads, SOURCE, "left").select(F.col(SOURCE).alias("source"), "lines", "status")

    def losses(self) -> DataFrame:
        """What a merge of each source would leave out: lines of another width, rows without a time, copies of a time."""
        is_one = lambda *of: F.col("reason").isin(*of)
        times = self.lines.where(is_one(OK, NO_TIME, WRONG_WIDTH)).groupBy(SOURCE, "reason", TIME).agg(F.count("*").alias("n"))
        sums = lambda condition, n: F.coalesce(F.sum(F.when(condition, n)), F.lit(0).cast("long"))
        return times.groupBy(F.col(SOURCE).alias("source")).agg(
            F.sum("n").alias("data_lines"),
            sums(is_one(WRONG_WIDTH), F.col("n")).alias("wrong_width"),
            sums(is_one(NO_TIME), F.col("n")).alias("invalid_time"),
            sums(is_one(OK, NO_TIME), F.col("n") - 1).alias("duplicate_times"),
        )


def parse_logs(
    lines: DataFrame, time_formats: Sequence[str] = (), columns: Sequence[str] | None = None, strict: bool = False
) -> ParsedLogs:
    """All lines parsed and stored: two reads of the text, one for the heads and one for everything else.

    With ``columns``, those of every source, it is one read; the heads are then found among what was stored, and a
    source with another header fails.
    """
    if columns is None:
        heads = materialize(log_heads(lines), "log-heads")
        parsed, sensors = _parsed(lines, _usable(heads, strict), heads, time_formats)
        return ParsedLogs(materialize(parsed, "log-lines"), heads, sensors)
    parsed, sensors = _parsed(lines, [list(columns)], None, time_formats)
    stored = materialize(parsed, "log-lines")
    # the text of a reading is not stored: a head that parses as one counts as no header
    found = log_heads(stored.select(*ROW_ORDER, F.coalesce(TEXT, F.lit("")).alias(TEXT)))
    heads = materialize(_with_known(found, columns), "log-heads")
    rows = stored.join(heads.select(SOURCE, "_board", "_header"), SOURCE)
    is_head = (F.col(TEXT) == F.col("_board")) | (F.col(TEXT) == F.col("_header"))
    reason = F.when(is_head & (F.col("reason") != BLANK), HEAD).otherwise(F.col("reason"))
    return ParsedLogs(rows.withColumn("reason", reason).select(*[c(n) for n in stored.columns]), heads, sensors)


def _with_known(heads: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Heads whose names are the known ones; others raise an error."""
    differs = F.raise_error(F.lit("a log header differs from the known columns")).cast("array<string>")
    same = F.col("_names") == F.array(*[F.lit(n) for n in columns])
    return heads.withColumn("_names", F.when(same, F.col("_names")).otherwise(differs))


def parse_log_lines(
    lines: DataFrame, time_formats: Sequence[str] = (), columns: Sequence[str] | None = None, strict: bool = False
) -> DataFrame:
    """Readings of log lines: ``_source``, the line order, ``DateTime`` and one double per sensor name.

    Lines with the wrong number of fields are dropped, unreadable fields become NULL. The first two
    lines of a source are its head. A source whose head is of no use is left out (:func:`log_audit`
    says why), and an error only if all are, or if ``strict``. ``columns`` states the columns of all
    sources; one with another header then fails. What else is asked of the same lines is cheaper from :func:`parse_logs`.
    """
    if columns is not None:
        return parse_logs(lines, time_formats, columns, strict).rows()
    heads = materialize(log_heads(lines), "log-heads")
    parsed, sensors = _parsed(lines, _usable(heads, strict), heads, time_formats)
    return ParsedLogs(parsed, heads, sensors).rows()


def log_audit(lines: DataFrame) -> DataFrame:
    """``(source, lines, status)`` of every source that has a line."""
    counted = lines.groupBy(SOURCE).agg(F.count("*").alias("lines"))
    return counted.join(log_heads(lines), SOURCE, "left").select(F.col(SOURCE).alias("source"), "lines", "status")


def log_losses(lines: DataFrame, time_formats: Sequence[str] = ()) -> DataFrame:
    """What a merge of each source would leave out, without storing the lines."""
    heads = materialize(log_heads(lines), "log-heads")
    parsed, sensors = _parsed(lines, _usable(heads, False), heads, time_formats)
    return ParsedLogs(parsed, heads, sensors).losses()


def read_station_logs(
    spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.txt", time_formats: Sequence[str] = (),
    columns: Sequence[str] | None = None, strict: bool = False, skip_unreadable: bool = False,
) -> DataFrame | None:
    """Parsed log files of one or more folders, or None if there are none."""
    lines = read_lines(spark, paths, pattern, skip_unreadable=skip_unreadable)
    return None if lines is None else parse_log_lines(lines, time_formats, columns, strict)


def without_order(df: DataFrame) -> DataFrame:
    return df.select(*[c(n) for n in df.columns if n not in (SOURCE, BLOCK, LINE)])
