"""Finding and reading text tables.

Files of one folder need not have the same columns. The header lines are read first and reduced to
the distinct ones; with a single header Spark's CSV reader does the rest, and with several the rows
are placed by the header of their file, still in one scan. Where the columns are known beforehand
they can be passed, which saves the look at the headers.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationloom.columns import c
from stationloom.errors import DataProcessingError, ValidationError
from stationloom.functions.clock import DAY, micros
from stationloom.operators.extract import date_range
from stationloom.storage import local_table, materialize

SOURCE, BLOCK, LINE, TEXT = "_source", "_block", "_line", "_text"
# Columns that keep the order of rows inside and across files, for keep-first rules.
ROW_ORDER = (SOURCE, BLOCK, LINE)


def _reader(spark: SparkSession, pattern: str | None, recursive: bool, skip_unreadable: bool) -> DataFrameReader:
    reader = spark.read.option("recursiveFileLookup", recursive).option("ignoreCorruptFiles", skip_unreadable)
    return reader.option("pathGlobFilter", pattern) if pattern else reader


def read_lines(
    spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None, recursive: bool = False,
    skip_unreadable: bool = False,
) -> DataFrame | None:
    """Lines of text files as ``(_source, _block, _line, _text)``; None if there is nothing to read.

    Large files are split over tasks: ``_block`` is the offset of the piece a line was read from and
    ``_line`` grows within a piece, so the three columns order the lines of a file.

    ``skip_unreadable`` leaves out what cannot be read of a file. It is off unless asked for, as it
    would also hide a passing fault of the storage.
    """
    try:
        lines = _reader(spark, pattern, recursive, skip_unreadable).text(paths)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    if lines.isEmpty():
        return None
    return lines.select(
        F.col("_metadata.file_path").alias(SOURCE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(LINE),
        F.col("value").alias(TEXT),
    )


def nth_lines(lines: DataFrame, n: int) -> DataFrame:
    """Line ``n`` (from 1) of every source: ``(_source, _text)``.

    Only first pieces are looked at, and each task hands on at most ``n`` lines per source.
    """
    first = Window.partitionBy(SOURCE).orderBy(LINE)
    return (
        lines.where(F.col(BLOCK) == 0)
        .withColumn("_n", F.row_number().over(first))
        .where(F.col("_n") <= n)
        .where(F.col("_n") == n)
        .select(SOURCE, TEXT)
    )


def stem(path: Column) -> Column:
    """File name without folders and extension."""
    name = F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]*$", "")
    # scans report paths as URIs, in which a plus sign is just that
    return F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


@dataclass(frozen=True)
class CsvTable:
    """Text columns of all files (NULL where a file lacks one) with the row order, and the layouts found.

    ``layouts`` maps a header line to its column names; with several of them ``rows`` says in
    ``_header`` which one a row's file has.
    """

    rows: DataFrame
    layouts: dict[str, tuple[str, ...]]

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys(n for names in self.layouts.values() for n in names))

    def pick(self, choose: Callable[[tuple[str, ...]], str | None]) -> Column:
        """The column that ``choose`` names for the layout of the row, NULL if it names none."""
        chosen = [(header, choose(names)) for header, names in self.layouts.items()]
        text = lambda n: F.lit(None).cast("string") if n is None else c(n)
        if len(chosen) == 1:
            return text(chosen[0][1])
        branches = F.lit(None).cast("string")
        for header, n in chosen:
            branches = F.when(F.col("_header") == header, text(n)).otherwise(branches)
        return branches

    def only(self, wanted: Callable[[tuple[str, ...]], bool]) -> CsvTable | None:
        """Without the files whose columns are not ``wanted``."""
        kept = {h: names for h, names in self.layouts.items() if wanted(names)}
        if not kept:
            return None
        rows = self.rows if len(kept) == len(self.layouts) else self.rows.where(F.col("_header").isin(list(kept)))
        return CsvTable(rows, kept)


def read_csv_table(
    spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None, recursive: bool = False,
    columns: Sequence[str] | None = None, skip_unreadable: bool = False,
) -> CsvTable | None:
    """CSV files with a header line as text columns; None if there is nothing to read.

    ``columns`` are the column names of every file, if they are known and the same; reading a file
    with another header then fails.
    """
    if columns is not None:
        layouts = {"": tuple(columns)}
    else:
        lines = read_lines(spark, paths, pattern, recursive, skip_unreadable)
        if lines is None:
            return None
        headers = materialize(nth_lines(lines, 1).where(F.trim(TEXT) != ""), "csv-headers")
        # one row per distinct header text
        layouts = {r[TEXT]: tuple(next(csv.reader([r[TEXT]]))) for r in headers.select(TEXT).distinct().collect()}
        layouts = dict(sorted(layouts.items()))
        if not layouts:
            return None
    if len(layouts) == 1:
        names = next(iter(layouts.values()))
        reader = _reader(spark, pattern, recursive, skip_unreadable).schema(_text_schema(names)).option("header", True)
        reader = reader.option("enforceSchema", columns is None)
        rows = reader.csv(paths).select(
            "*",
            F.col("_metadata.file_path").alias(SOURCE),
            F.col("_metadata.file_block_start").alias(BLOCK),
            F.monotonically_increasing_id().alias(LINE),
        )
        return CsvTable(rows, layouts)

    every = CsvTable(lines, layouts).columns
    widest = max(len(names) for names in layouts.values())
    cells = F.from_csv(F.col(TEXT), F.lit(_text_schema([f"_{i}" for i in range(widest)])))
    rows = (
        lines.join(headers.select(SOURCE, F.col(TEXT).alias("_header")), SOURCE, "inner")
        .where((F.col(TEXT) != F.col("_header")) & (F.trim(TEXT) != ""))
        .withColumn("_cells", cells)
    )

    def place(n: str) -> Column:
        branches = F.lit(None).cast("string")
        for header, names in layouts.items():
            if n in names:
                branches = F.when(F.col("_header") == header, F.col(f"_cells._{names.index(n)}")).otherwise(branches)
        return branches

    return CsvTable(rows.select(*[place(n).alias(n) for n in every], *ROW_ORDER, "_header"), layouts)


def _text_schema(names: Sequence[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` string" for n in names)


def file_audit(lines: DataFrame, min_lines: int = 1) -> DataFrame:
    """Lines per file and whether it is worth reading. Files without any line do not show up in a scan."""
    return lines.groupBy(SOURCE).agg(F.count("*").alias("lines")).select(
        F.col(SOURCE).alias("source"),
        "lines",
        F.when(F.col("lines") < min_lines, "too short").otherwise("ok").alias("status"),
    )


def found_files(
    spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None, recursive: bool = False, empty: bool = True
) -> DataFrame | None:
    """``(_source, bytes)`` of every file that is there; None if the paths lead nowhere.

    Only names and lengths are asked for, so no content is read, and the names stay in the tasks. Scans pass over files
    without any byte; with ``empty`` they are found by the names that Spark's listing holds in the driver anyway.
    """
    try:
        files = _reader(spark, pattern, recursive, False).format("binaryFile").load(paths)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    found = files.select(F.col("_metadata.file_path").alias(SOURCE), F.col("length").alias("bytes"))
    if not empty:
        return found
    names = local_table(spark, [(n,) for n in files.inputFiles()], f"{SOURCE} string").select(_one_spelling(SOURCE).alias(SOURCE))
    if pattern:
        fits = spark._jvm.org.apache.hadoop.fs.GlobPattern(pattern).compiled().pattern()
        names = names.where(F.try_url_decode(F.replace(F.regexp_extract(SOURCE, "([^/]+)$", 1), F.lit("+"), F.lit("%2B"))).rlike(f"^(?:{fits})$"))
    found = found.select(_one_spelling(SOURCE).alias(SOURCE), "bytes")
    return found.unionByName(names.join(found, SOURCE, "left_anti").withColumn("bytes", F.lit(0).cast("long")))


def _one_spelling(path: str) -> Column:
    """Paths of local files are written in two ways."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def with_unread(found: DataFrame, read: DataFrame, lines: str = "lines", nothing: str = "no readable line") -> DataFrame:
    """An audit ``read`` (source, lines, maybe status) with the files that gave no line added, and the bytes of all.

    ``nothing`` is the status of files with bytes of which no line came: they cannot be read, or hold nothing of use.
    """
    n = F.coalesce(c(lines), F.lit(0).cast("long"))
    state = F.when(F.col("bytes") == 0, "empty file").when(n == 0, nothing)
    known = F.col("status") if "status" in read.columns else F.lit(None).cast("string")
    rest = [k for k in read.columns if k not in ("source", lines, "status")]
    read = read.withColumn("_path", _one_spelling("source")).drop("source")
    return found.select(_one_spelling(SOURCE).alias("source"), "bytes").join(read, F.col("source") == F.col("_path"), "left").select(
        "source", "bytes", n.alias(lines), *[F.coalesce(c(k), F.lit(0).cast("long")).alias(k) for k in rest],
        F.coalesce(state, known, F.lit("ok")).alias("status"),
    )


def audited_files(
    spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None, recursive: bool = False,
    skip_unreadable: bool = False,
) -> DataFrame:
    """Every file that was found, also empty ones, with its line count: ``(source, bytes, lines, status)``.

    With ``skip_unreadable`` a file that cannot be read is named here; else it is an error. Of a compressed file that breaks off
    after its first block, the lines before that are counted.
    """
    found = found_files(spark, paths, pattern, recursive)
    if found is None or found.isEmpty():
        raise ValidationError(f"no file found at {paths}")
    lines = read_lines(spark, paths, pattern, recursive, skip_unreadable)
    if lines is None:
        return with_unread(found, spark.createDataFrame([], "source string, lines long"))
    return with_unread(found, lines.groupBy(F.col(SOURCE).alias("source")).agg(F.count("*").alias("lines")))


def first_failed(audit: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` sources by name that are of no use; more are not named in an error."""
    return audit.where("status <> 'ok'").orderBy("source").limit(n).select("source", "status")


def require_some(audit: DataFrame) -> None:
    """Fail, naming the first five bad files, if none of the files is usable."""
    if audit.where("status = 'ok'").limit(1).count() == 0:
        bad = [f"{r['source']}: {r['status']}" for r in first_failed(audit).collect()]
        raise DataProcessingError("no file could be used: " + "; ".join(bad))


#: The time a clustered table is ordered by, in microseconds.
CLUSTER_TIME = "_clustered_us"


def read_period(
    spark: SparkSession, path: str, schema: T.StructType, time_col: str, start: str | None, end: str | None,
    end_inclusive_day: bool = False,
) -> DataFrame:
    """``date_range`` of a clustered table; files and row groups outside the period are not read."""
    table = spark.read.schema(T.StructType([*schema.fields, T.StructField(CLUSTER_TIME, T.LongType())])).parquet(path)
    us = F.col(CLUSTER_TIME)
    if start is not None:
        table = table.where(us >= micros(F.lit(start).cast("timestamp_ntz")))
    if end is not None:
        table = table.where(us < micros(F.lit(end).cast("timestamp_ntz")) + DAY)
    return date_range(table, time_col, start, end, end_inclusive_day).select(*map(c, schema.names))


def hashable(kind: T.DataType) -> bool:
    """Whether Spark hashes values of this type (maps and variants it does not)."""
    if isinstance(kind, T.ArrayType):
        return hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), fmt: str = "parquet",
    measure: Callable[[DataFrame], DataFrame] | None = None, cluster: bool = False,
) -> None:
    """Overwrite a table. Partitioned tables are rebalanced first, so that a hot partition is written by
    several tasks and a small one by a single task; rows are ordered within each file only.

    With ``cluster`` the rows are dealt by sampled ranges of ``partition_by`` and ``sort_by`` (a time first) instead: the
    files of a partition follow each other and meet in equal values at most. As Spark holds no filter on a naive time
    against the statistics of files, the time is stored as microseconds too, and ``read_period`` skips files by those.
    Sampling runs the steps since the last shuffle twice; the number of shuffle partitions decides how large files are. Rows
    with equal or no values (such as no time) are dealt by the rest of the row, only whole copies of a row stay together.

    ``measure`` may observe the rows on their way: it is put behind the last shuffle, into the tasks that write, whose
    metrics Spark counts once however often a task is run."""
    if cluster:
        ties = [c(f.name) for f in df.schema.fields if f.name not in (*partition_by, *sort_by) and hashable(f.dataType)]
        df = df.repartitionByRange(*map(c, (*partition_by, *sort_by)), *([F.xxhash64(*ties)] if ties else []))
        if CLUSTER_TIME in df.columns:
            raise ValidationError(f"a clustered table has a column {CLUSTER_TIME} of its own")
        df = df.withColumn(CLUSTER_TIME, micros(c(sort_by[0])))
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    if measure:
        df = measure(df)
    if sort_by:
        df = df.sortWithinPartitions(*map(c, (*partition_by, *sort_by)))
    if fmt == "csv":
        # the writer's own format would cut times to milliseconds
        times = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))}
        df = df.select(*[c(n).cast("string").alias(n) if n in times else c(n) for n in df.columns])
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
