"""Missing-rate report over several kinds of datasets."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from stationloom.errors import StationLoomError, ValidationError
from stationloom.operators import missing
from stationloom.sources import merge
from stationloom.storage import materialize


@dataclass(frozen=True)
class MissingRateReport:
    """Rates of all kinds that worked (None if none did), and what went wrong for the others."""

    rates: DataFrame | None
    failed: dict[str, str]


def missing_rate_report(
    datasets: Mapping[str, Mapping[str, DataFrame] | missing.LongTables],
    time_col: str = merge.TIME,
    hours: tuple[int, int] | None = missing.DAYLIGHT_HOURS,
    change_date: str = missing.CHANGE_DATE,
    per_part: int = missing.SENSORS_PER_PART,
) -> MissingRateReport:
    """Monthly rates by sensor group of every kind, with pages and titles.

    A time that only some tables of a kind have counts as missing in the others. Each kind is computed by itself; one that
    fails, for example for duplicate times, does not stop the rest. Tables come as DataFrames by name, or as long tables
    (:func:`stationloom.sources.merge.read_long`), which may be any number of files.
    """
    rates, failed = [], {}
    for kind, tables in sorted(datasets.items()):
        try:
            long = tables if isinstance(tables, missing.LongTables) else merge.long_tables(tables, time_col)
            found = missing.long_missing_rates(long, kind, hours, change_date)
            rates.append(materialize(missing.paged_rates(found, long.sensors, kind, per_part), "rates"))
        except (StationLoomError, PySparkException, Py4JJavaError) as e:
            failed[kind] = f"{type(e).__name__}: {e}"
    return MissingRateReport(merge.union_by_name(rates) if rates else None, failed)


def load_tables(spark: SparkSession, folder: str, pattern: str = "*.csv") -> missing.LongTables:
    """CSV tables of a folder, one per file, by file name, in one scan however many there are."""
    tables = merge.read_long(spark, folder, pattern)
    if tables is None:
        raise ValidationError(f"no table {pattern!r} with any content in {folder}")
    return tables
