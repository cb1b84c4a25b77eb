"""Table contracts and integrity checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationloom.columns import c, nan_to_null, unpivot_stats
from stationloom.errors import DataIntegrityError, ValidationError
from stationloom.functions.parse import parse_time
from stationloom.operators import series


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key by ``order``, or by all other columns if there is none; NULL is a key like any other.

    Spark limits each key to its first row within every map task before it shuffles, so a key with
    very many copies does not end up in one task.
    """
    # rows that tie are told apart by what they hold, so that runs agree
    first = Window.partitionBy(*[c(k) for k in keys]).orderBy(*(order or [c(n) for n in df.columns if n not in keys] or [F.lit(1)]))
    return df.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop("_place")


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows in all, and rows beyond the first of their key."""
    return (
        df.groupBy(*[c(k) for k in keys]).agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("total_rows"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("long")).alias("duplicate_count"),
        )
    )


def check_duplicates(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], raise_on_error: bool = False
) -> tuple[DataFrame, int]:
    """Table without duplicates, and how many were removed. Runs a job for the count."""
    n = duplicate_count(df, keys).first()["duplicate_count"]
    if n and raise_on_error:
        raise DataIntegrityError(f"{n} duplicate rows by {list(keys)}")
    return (dedupe_keep_first(df, keys, order) if n else df), n


def missing_ratio(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), above: float = 0.0) -> DataFrame:
    """``(keys, column, missing_ratio)`` for columns with a larger share of NULLs than ``above``."""
    shares = nan_to_null(df).groupBy(*[c(k) for k in keys]).agg(
        *[F.avg(c(n).isNull().cast("double")).alias(f"_m{i}") for i, n in enumerate(columns)]
    )
    entries = [{"column": F.lit(n), "missing_ratio": c(f"_m{i}")} for i, n in enumerate(columns)]
    return unpivot_stats(shares, keys, entries).where(F.col("missing_ratio") > above)


def check_missing(
    df: DataFrame, columns: Sequence[str], max_missing_ratio: float = 0.5, raise_on_error: bool = False
) -> dict[str, float]:
    """Missing share per column that has any; strict mode fails above the limit."""
    found = {r["column"]: r["missing_ratio"] for r in missing_ratio(df, columns).collect()}  # a row per column
    excessive = {n: r for n, r in found.items() if r > max_missing_ratio}
    if excessive and raise_on_error:
        raise DataIntegrityError("too much missing: " + ", ".join(f"{n} {r:.1%}" for n, r in excessive.items()))
    return found


def value_range_counts(df: DataFrame, ranges: Mapping[str, tuple[float, float]], keys: Sequence[str] = ()) -> DataFrame:
    """Readings below the minimum or above the maximum (bounds themselves are fine); only if there are any."""
    present = {n: r for n, r in ranges.items() if n in df.columns}
    if not present:
        raise ValidationError("no column with a range is in the table")
    measures, entries = [], []
    for i, (n, (low, high)) in enumerate(present.items()):
        measures += [F.count_if(c(n) < low).alias(f"_b{i}"), F.count_if(c(n) > high).alias(f"_a{i}")]
        below, above = c(f"_b{i}"), c(f"_a{i}")
        entries.append(
            {"column": F.lit(n), "below_min": below, "above_max": above, "out_of_range": below + above}
        )
    counted = nan_to_null(df).groupBy(*[c(k) for k in keys]).agg(*measures)
    return unpivot_stats(counted, keys, entries).where("out_of_range > 0")


def check_value_ranges(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]], raise_on_error: bool = False
) -> dict[str, int]:
    if not any(n in df.columns for n in ranges):
        return {}
    found = {r["column"]: r["out_of_range"] for r in value_range_counts(df, ranges).collect()}  # a row per column
    if found and raise_on_error:
        raise DataIntegrityError(f"out-of-range values in {len(found)} columns: {found}")
    return found


def check_temporal(
    df: DataFrame, time_col: str, expected_seconds: float | None = None, raise_on_error: bool = False
) -> DataFrame:
    """:func:`series.temporal_consistency`; strict mode fails on gaps or on time running backwards."""
    if time_col not in df.columns:
        raise ValidationError(f"time column {time_col!r} not found")
    report = series.temporal_consistency(df, time_col, expected_seconds=expected_seconds)
    if raise_on_error:
        row = report.first()
        if expected_seconds and row["gap_count"]:
            raise DataIntegrityError(f"{row['gap_count']} gaps, the largest {row['max_interval_s']} s")
        if row["backwards"]:
            raise DataIntegrityError(f"{row['backwards']} times going backwards")
    return report


def table_summary(df: DataFrame, time_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Records, columns and time range per key, in one pass."""
    return df.groupBy(*[c(k) for k in keys]).agg(
        F.count("*").alias("records"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
        F.min(c(time_col)).alias("start"),
        F.max(c(time_col)).alias("end"),
    )


def validate_table(
    df: DataFrame, required_columns: Sequence[str] = (), min_rows: int = 1, allow_empty: bool = False
) -> DataFrame:
    """The table itself, if it has the columns and enough rows; reads no more than ``min_rows`` rows."""
    if not hasattr(df, "schema"):
        raise ValidationError(f"expected a DataFrame, got {type(df).__name__}")
    wanted = max(min_rows, 1)
    rows = df.limit(wanted).count()
    if rows == 0 and allow_empty:
        return df
    if rows == 0:
        raise ValidationError("the table is empty")
    if rows < wanted:
        raise ValidationError(f"the table has {rows} rows, {wanted} are needed")
    missing = [n for n in required_columns if n not in df.columns]
    if missing:
        raise ValidationError(f"missing columns {missing}; available: {df.columns}")
    return df


def validate_time_column(df: DataFrame, time_col: str, formats: Sequence[str] = ()) -> DataFrame:
    """The time column as ``timestamp_ntz``; text is parsed and becomes NULL where it cannot be."""
    if time_col not in df.columns:
        raise ValidationError(f"time column {time_col!r} not found among {df.columns}")
    kind = df.schema[time_col].dataType
    if isinstance(kind, T.TimestampNTZType):
        return df
    if isinstance(kind, (T.TimestampType, T.DateType)):
        typed = c(time_col).cast("timestamp_ntz")
    elif isinstance(kind, T.StringType):
        typed = parse_time(c(time_col), formats)
    else:
        raise ValidationError(f"column {time_col!r} of type {kind.simpleString()} cannot be a time")
    return df.select(*[typed.alias(n) if n == time_col else c(n) for n in df.columns])


def time_contract(df: DataFrame, time_col: str, keys: Sequence[str] = (), formats: Sequence[str] = ()) -> DataFrame:
    """Per key: rows, rows whose time is missing or cannot be read, and the range of the others."""
    ts = c(time_col)
    return validate_time_column(df, time_col, formats).groupBy(*[c(k) for k in keys]).agg(
        F.count("*").alias("records"), F.count_if(ts.isNull()).alias("without_time"),
        F.min(ts).alias("start"), F.max(ts).alias("end"),
    )


CONTRACT_REPORT = "rule string, column string, found long, low long, high long, ok boolean"


@dataclass(frozen=True)
class TableContract:
    """What a table has to hold. Limits that are None are counted and not judged.

    ``ranges`` are bounds that are fine themselves; NULL and NaN are never out of range, columns that are not there are not
    looked at. ``strict`` makes a broken rule an error where the contract is checked, else it is only reported.
    """

    required_columns: Sequence[str] = ()
    min_rows: int = 0
    max_without_time: int | None = None
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    max_out_of_range: int | None = None
    strict: bool = False


def _contract_rules(df: DataFrame, time_col: str, contract: TableContract) -> list[tuple[str, str | None, Column | int, int | None, int | None]]:
    """(rule, column, measure, lowest, highest) of everything a contract asks of a table.

    Measures are aggregates, or numbers where the schema is enough.
    """
    found: list = [("required_column", n, int(n in df.columns), 1, None) for n in contract.required_columns]
    found.append(("rows", None, F.count(F.lit(1)), contract.min_rows, None))
    if time_col in df.columns:
        found.append(("without_time", time_col, F.count_if(c(time_col).isNull()), None, contract.max_without_time))
    for n, (low, high) in contract.ranges.items():
        if n in df.columns:
            v = c(n).cast("double")
            outside = (v < low) | ((v > high) & ~F.isnan(v))
            found.append(("out_of_range", n, F.count_if(outside), None, contract.max_out_of_range))
    return found


def contract_report(df: DataFrame, time_col: str, contract: TableContract) -> DataFrame:
    """``(rule, column, found, low, high, ok)`` of a table, in one aggregation over it."""
    listed = _contract_rules(df, time_col, contract)
    long = lambda v: F.lit(v).cast("long")
    one = df.agg(*[m.alias(f"_{i}") for i, (_, _, m, _, _) in enumerate(listed) if isinstance(m, Column)])
    rows = []
    for i, (rule, column, m, low, high) in enumerate(listed):
        n = F.col(f"_{i}") if isinstance(m, Column) else long(m)
        ok = F.coalesce(n >= long(low), F.lit(True)) & F.coalesce(n <= long(high), F.lit(True))
        rows.append(F.struct(
            F.lit(rule).alias("rule"), F.lit(column).cast("string").alias("column"), n.alias("found"),
            long(low).alias("low"), long(high).alias("high"), ok.alias("ok"),
        ))
    return one.select(F.inline(F.array(*rows)))


class ContractWatch:
    """A contract measured on rows that go by anyway: no read of its own.

    ``watch`` puts the measures into the plan of a table that is about to be written, ``report`` gives the rows of
    :func:`contract_report` after the write, and raises if the contract is strict and broken.
    """

    def __init__(self, time_col: str, contract: TableContract = TableContract()):
        self.time_col, self.contract = time_col, contract
        self._seen = Observation()
        self._rules: list = []

    def watch(self, df: DataFrame) -> DataFrame:
        self._rules = _contract_rules(df, self.time_col, self.contract)
        measures = [m.alias(f"_{i}") for i, (_, _, m, _, _) in enumerate(self._rules) if isinstance(m, Column)]
        return df.observe(self._seen, *measures)

    def report(self) -> list[tuple[str, str | None, int, int | None, int | None, bool]]:
        seen, rows = self._seen.get, []
        for i, (rule, column, m, low, high) in enumerate(self._rules):
            n = seen[f"_{i}"] if isinstance(m, Column) else m
            rows.append((rule, column, n, low, high, (low is None or n >= low) and (high is None or n <= high)))
        broken = [f"{r[0]}{f' of {r[1]}' if r[1] else ''}: {r[2]}" for r in rows if not r[-1]]
        if broken and self.contract.strict:
            raise DataIntegrityError("table breaks its contract: " + ", ".join(broken))
        return rows
