"""The whole job: merge, quality control, downsampling, gap filling, extraction, missing-rate report.

Each kind of data is one table with a ``device`` key, however many stations there are, so a stage is
one plan per kind and not one per station. Stages are lazy; a stage's table is written once and the
next stage reads the files, which cuts lineage and prunes columns and devices at the scan.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationloom.columns import c
from stationloom.errors import ConfigurationError, DataProcessingError, ValidationError
from stationloom.functions.frequency import parse_frequency
from stationloom.operators import extract, integrity, missing, series
from stationloom.operators.interpolate import interpolate_by_rules, interpolation_stats, ruled_columns
from stationloom.operators.resample import resample
from stationloom.plans.quality import QualityRules, quality_control
from stationloom.plans.report import missing_rate_report
from stationloom.rules import ConstantRule, ExtractFile, ExtractTasks, FailureWindow, GapRules, RangeRule
from stationloom.sources import merge
from stationloom.sources.files import found_files, with_unread, write_table
from stationloom.storage import local_table

TIME, DEVICE = merge.TIME, "device"
KINDS = ("microclimate", "power", "weather")
STAGES = ("merged", "quality_controlled", "downsampled", "interpolated")
# Suffixes of what lies before and after the change of planting, and what is split.
PART1, PART2 = "_WT", "_WT-to-Sed"
SPLIT_TABLE_PATTERN = "WedTri"
SPLIT_COLUMN_TABLES = ("power/PV_Power",)
# Only power is summarized over daylight hours.
SUMMARY_HOURS = {"power": missing.DAYLIGHT_HOURS}


@dataclass(frozen=True)
class PipelineConfig:
    """Inputs are folders; a kind without input is left out. ``output_root`` is shared storage.

    ``known_columns`` gives the columns of text sources whose files all have the same, by
    ``"device_sheets"``, ``"power"``, ``"station_logs"`` or the name of a weather file; files with another header then fail.
    ``time_formats`` gives, by the same names or ``"weather"``, formats of times beyond the usual forms.
    ``strict_logs`` makes one unusable log an error; else it is left out and listed in the
    ``sources_logs`` table. ``skip_unreadable`` leaves out files that cannot be read; they are listed in the ``sources_...``
    tables, as are empty ones.
    ``contracts`` says by stage and kind (``"merged/power"``) what a stored table must hold. Every stage table is measured
    while it is written (tables ``contracts_...``); a broken contract ends the run only if it is strict.
    """

    output_root: str
    device_sheets: str | None = None
    station_logs: Mapping[str, str] = field(default_factory=dict)
    power: str | None = None
    weather: str | None = None
    known_columns: Mapping[str, Sequence[str]] = field(default_factory=dict)
    time_formats: Mapping[str, Sequence[str]] = field(default_factory=dict)
    strict_logs: bool = False
    skip_unreadable: bool = False
    ranges: Mapping[str, Sequence[RangeRule]] = field(default_factory=dict)
    constants: Sequence[ConstantRule] = ()
    failures: Sequence[FailureWindow] = ()
    contracts: Mapping[str, integrity.TableContract] = field(default_factory=dict)
    downsample: bool = True
    frequency: str = "1h"
    interpolate: bool = True
    gaps: GapRules = GapRules()
    tasks: ExtractTasks = ExtractTasks()
    split_date: str = missing.CHANGE_DATE
    report: bool = True
    sensors_per_part: int = missing.SENSORS_PER_PART
    table_format: str = "parquet"
    run_id: str | None = None


@dataclass(frozen=True)
class PipelineResult:
    root: str
    stages: dict[str, dict[str, DataFrame]]
    extracted: dict[str, DataFrame]
    stats: dict[str, DataFrame]
    failed_reports: dict[str, str] = field(default_factory=dict)


def run_name(downsample: bool, interpolate: bool, now: datetime | None = None) -> str:
    flag = lambda on: "true" if on else "false"
    stamp = (now or datetime.now()).strftime("%Y%m%d_%H%M%S")
    return f"{stamp}_downsample_{flag(downsample)}_interpolate_{flag(interpolate)}"


def check_stages(downsample: bool, interpolate: bool) -> None:
    if interpolate and not downsample:
        raise ConfigurationError("gap filling works on the downsampled grid; enable downsampling or disable both")


def choose_stage(stages: Mapping[str, Mapping[str, DataFrame]], downsample: bool, interpolate: bool) -> Mapping[str, DataFrame]:
    """Tables to extract from: interpolated, else downsampled, else quality-controlled."""
    if interpolate and stages.get("interpolated"):
        return stages["interpolated"]
    if downsample and stages.get("downsampled"):
        return stages["downsampled"]
    return stages.get("quality_controlled", {})


@dataclass(frozen=True)
class Merged:
    """One table per kind of data, keyed by device; (device, column) of each kind by its files; tables about sources."""

    tables: dict[str, DataFrame]
    layouts: dict[str, DataFrame]
    about: dict[str, DataFrame]


def merge_kinds(spark: SparkSession, cfg: PipelineConfig) -> Merged:
    tables: dict[str, DataFrame] = {}
    layouts: dict[str, DataFrame] = {}
    about: dict[str, DataFrame] = {}
    parts, headers = [], []
    known = cfg.known_columns.get
    formats = lambda source: cfg.time_formats.get(source, ())
    if cfg.device_sheets:
        sheets = merge.read_device_tables(
            spark, cfg.device_sheets, device=DEVICE, time_formats=formats("device_sheets"),
            columns=known("device_sheets"), skip_unreadable=cfg.skip_unreadable,
        )
        if sheets is not None:
            parts.append(sheets[0])
            headers.append(sheets[1])
    logs = merge.merge_all_station_logs(
        spark, cfg.station_logs, DEVICE, time_formats=formats("station_logs"), columns=known("station_logs"),
        strict=cfg.strict_logs, skip_unreadable=cfg.skip_unreadable,
    )
    if logs is not None:
        parts.append(logs.rows)
        headers.append(logs.layout)
        about |= {"sources_logs": logs.audit, "losses_logs": logs.losses}
    if parts:
        tables["microclimate"], layouts["microclimate"] = merge.union_by_name(parts), merge.union_by_name(headers)
    if cfg.power:
        power = merge.merge_power_files(
            spark, cfg.power, time_formats=formats("power"), columns=known("power"), skip_unreadable=cfg.skip_unreadable
        )
        tables["power"] = power.rows.withColumn(DEVICE, F.lit("power_merged"))
        found = found_files(spark, cfg.power, merge.POWER_PATTERN)
        about["sources_power"] = with_unread(found, power.losses, "data_lines")
    if cfg.weather:
        weather = merge.merge_weather_files(
            spark, cfg.weather, time_formats=formats("weather"), known=cfg.known_columns, skip_unreadable=cfg.skip_unreadable
        )
        tables["weather"] = weather.rows.withColumn(DEVICE, F.lit("weather_merged"))
        found = found_files(spark, cfg.weather, "*.csv")
        about["sources_weather"] = with_unread(found, weather.losses, "data_lines", "not used")
    if not tables:
        raise DataProcessingError("no input gave any table")
    for kind in ("power", "weather"):
        if kind in tables:
            names = [n for n in tables[kind].columns if n not in (TIME, DEVICE)]
            layouts[kind] = local_table(spark, [(f"{kind}_merged", n) for n in names], f"{DEVICE} string, column string")
    return Merged(tables, layouts, about)


def named_columns(layout: DataFrame, devices: Sequence[str]) -> dict[str, set[str]]:
    """The columns of the devices named by extraction tasks, also those without a reading: a row per device and column."""
    found: dict[str, set[str]] = {}
    for r in layout.where(c(DEVICE).isin(list(devices))).distinct().collect():
        found.setdefault(r[DEVICE], {TIME}).add(r["column"])
    return found


def present_columns(table: DataFrame, devices: Sequence[str]) -> dict[str, set[str]]:
    """As :func:`named_columns`, for tables whose files are not known: the columns that hold a reading."""
    sensors = [n for n in table.columns if n not in (TIME, DEVICE)]
    found = table.where(c(DEVICE).isin(list(devices))).groupBy(c(DEVICE)).agg(
        *[F.max(c(n).isNotNull()).alias(f"_{i}") for i, n in enumerate(sensors)]
    )
    return {
        r[DEVICE]: {TIME, *[n for i, n in enumerate(sensors) if r[f"_{i}"]]} for r in found.collect()
    }


def device_table(tables: Mapping[str, DataFrame], columns: Mapping[str, Mapping[str, set[str]]], name: str) -> DataFrame | None:
    """``kind/device`` as a table of its own with the columns that device has; None if there is no such device."""
    kind, _, device = name.partition("/")
    if kind not in tables or device not in columns.get(kind, {}):
        return None
    table = tables[kind]
    own = [n for n in table.columns if n in columns[kind][device]]
    return table.where(c(DEVICE) == device).select(*[c(n) for n in own])


def extract_one(spec: ExtractFile, tasks: ExtractTasks, tables, columns, end_inclusive_day: bool = False) -> DataFrame | None:
    """The dataset of one task entry: period, selected columns, joined sources of the same kind."""
    start, end = spec.start or tasks.start, spec.end or tasks.end

    def period(name: str) -> DataFrame | None:
        df = device_table(tables, columns, name)
        return None if df is None else extract.date_range(df, TIME, start, end, end_inclusive_day)

    base = period(spec.table)
    result = None if base is None else extract.select_rename(base, spec.columns)
    if result is None:
        return None
    kind = spec.table.partition("/")[0]
    sources = [(period(f"{kind}/{s.table.rpartition('/')[2]}"), s.columns) for s in spec.merge_from]
    return extract.join_sources(result, [(df, cols) for df, cols in sources if df is not None], [TIME])


def extract_tasks(tasks: ExtractTasks, tables: Mapping[str, DataFrame], columns) -> list[tuple[str, str, DataFrame]]:
    """(task, output, dataset) of every entry that has data."""
    found = []
    for task, specs in tasks.tasks.items():
        for spec in specs:
            df = extract_one(spec, tasks, tables, columns)
            if df is not None:
                found.append((task, spec.output, df))
    return found


MANIFEST = "step string, state string, fingerprint string, inputs string, tables array<struct<name: string, schema: string>>"
STARTED, DONE = "started", "done"


class _Store:
    """Tables below the run folder: written once, read back as files.

    A step is a group of tables that are worth something together. Its record in ``manifest/`` says ``started`` before
    the first table is written and ``done``, with the schemas, after the last one, so a step that was broken off is
    never taken for whole. A step that is done for the same settings, and those of all steps before it, is not run again.
    """

    def __init__(self, spark: SparkSession, root: str, contracts: Mapping[str, integrity.TableContract] | None = None):
        self.spark, self.root, self.contracts = spark, root, contracts or {}
        self.settings = ""
        self.records = stored_steps(spark, root)

    def write(self, df: DataFrame, name: str, by_device: bool = True, measure=None) -> DataFrame:
        order = [TIME] if TIME in df.columns else []
        write_table(df, f"{self.root}/{name}", [DEVICE] if by_device else [], order, measure=measure)
        return self.read(name, df.schema)

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def step(self, name: str, settings: Sequence, build: Callable[[Callable[..., DataFrame]], None]) -> dict[str, DataFrame]:
        """The tables of a step; ``build`` gets a function that stores a table under a name, if the step has to run."""
        inputs = "; ".join(map(repr, settings))
        self.settings = sha256(f"{self.settings} {name} {inputs}".encode()).hexdigest()
        known = self.records.get(name)
        if known and known["state"] == DONE and known["fingerprint"] == self.settings:
            return {t["name"]: self.read(t["name"], T.StructType.fromJson(json.loads(t["schema"]))) for t in known["tables"]}
        found: dict[str, DataFrame] = {}
        measured: list[tuple] = []

        def put(df: DataFrame, table: str, by_device: bool = True) -> DataFrame:
            if not table.startswith(f"{name}/"):
                found[table] = self.write(df, table, by_device)
                return found[table]
            watch = integrity.ContractWatch(TIME, self.contracts.get(table, integrity.TableContract()))
            found[table] = self.write(df, table, by_device, watch.watch)
            measured.extend((table, *r) for r in watch.report())
            return found[table]

        self._record(name, STARTED, inputs, {})
        build(put)
        report = local_table(self.spark, measured, f"`table` string, {integrity.CONTRACT_REPORT}")
        put(report, f"stats/contracts_{name}", False)
        self._record(name, DONE, inputs, found)
        return found

    def _record(self, name: str, state: str, inputs: str, tables: Mapping[str, DataFrame]) -> None:
        row = (name, state, self.settings, inputs, [(n, df.schema.json()) for n, df in tables.items()])
        one = self.spark.createDataFrame([row], MANIFEST).coalesce(1)
        one.write.mode("overwrite").json(f"{self.root}/manifest/{name}")

    def deliver(self, df: DataFrame, name: str, fmt: str) -> DataFrame:
        path = f"{self.root}/extracted/{name}"
        write_table(df, path, (), [TIME], fmt)
        reader = self.spark.read.schema(df.schema)
        return reader.parquet(path) if fmt == "parquet" else reader.option("header", True).csv(path)


def stored_steps(spark: SparkSession, root: str) -> dict[str, Row]:
    """The records of a run's steps, a handful."""
    try:
        records = spark.read.schema(MANIFEST).option("recursiveFileLookup", True).json(f"{root}/manifest")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return {}
        raise
    return {r["step"]: r for r in records.collect()}


def stored_stages(spark: SparkSession, root: str) -> dict[str, dict[str, DataFrame]]:
    """The whole stages of an earlier run, by stage and kind; what was broken off is left out."""
    stages: dict[str, dict[str, DataFrame]] = {}
    for name, r in stored_steps(spark, root).items():
        if r["state"] == DONE and name in STAGES:
            for t in r["tables"]:
                stage, _, kind = t["name"].partition("/")
                if stage == name:
                    df = spark.read.schema(T.StructType.fromJson(json.loads(t["schema"]))).parquet(f"{root}/{t['name']}")
                    stages.setdefault(stage, {})[kind] = df
    return stages


def extract_from_run(spark: SparkSession, root: str, cfg: PipelineConfig) -> PipelineResult:
    """Extraction and report from the stages of an earlier run, without its inputs.

    Of interpolated, downsampled and quality-controlled tables, the first that the settings ask for and the run has are taken;
    results are written below ``output_root`` as by a run of their own.
    """
    stages = stored_stages(spark, root)
    tables = choose_stage(stages, cfg.downsample, cfg.interpolate and cfg.gaps.enabled)
    if not tables:
        raise DataProcessingError(f"no whole stage to extract from in {root}")
    known = stored_steps(spark, root)["merged"]["tables"]
    layouts = {
        t["name"].partition("/")[2]: spark.read.schema(T.StructType.fromJson(json.loads(t["schema"]))).parquet(f"{root}/{t['name']}")
        for t in known if t["name"].startswith("layout/")
    }
    own = f"{cfg.output_root.rstrip('/')}/{cfg.run_id or run_name(cfg.downsample, cfg.interpolate)}"
    stats: dict[str, DataFrame] = {}
    extracted, failed = _deliver(cfg, _Store(spark, own), tables, layouts, stats)
    return PipelineResult(own, stages, extracted, stats, failed)


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> PipelineResult:
    """Run all enabled stages and write every stage's tables and statistics below ``output_root``.

    With the ``run_id`` of a run that ended early, it is taken up after its last whole stage of the same settings; the
    inputs of stages that are done are not looked at.
    """
    interpolate = cfg.interpolate and cfg.gaps.enabled
    check_stages(cfg.downsample, interpolate)
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC"):
        raise ValidationError("set spark.sql.session.timeZone to UTC; times are naive")
    step = parse_frequency(cfg.frequency)
    if interpolate and step.seconds is None:
        raise ConfigurationError("gap filling needs a fixed frequency such as '1h'")
    root = f"{cfg.output_root.rstrip('/')}/{cfg.run_id or run_name(cfg.downsample, interpolate)}"
    store = _Store(spark, root, cfg.contracts)
    stages: dict[str, dict[str, DataFrame]] = {}
    stats: dict[str, DataFrame] = {}

    def keep(name: str, found: Mapping[str, DataFrame]) -> None:
        """Tables of a step, by kind, and statistics."""
        stages[name] = {k.partition("/")[2]: df for k, df in found.items() if k.startswith(f"{name}/")}
        stats.update({k.partition("/")[2]: df for k, df in found.items() if k.startswith("stats/")})

    def limits(step: str) -> list:
        """The contracts of a step are among its settings, where it has any."""
        return sorted((k, v) for k, v in cfg.contracts.items() if k.startswith(f"{step}/"))

    def merging(put) -> None:
        merged = merge_kinds(spark, cfg)
        tables = {k: put(df, f"merged/{k}") for k, df in merged.tables.items()}
        for k, df in merged.layouts.items():
            put(df, f"layout/{k}", False)
        for name, df in merged.about.items():
            put(df, f"stats/{name}", False)
        for kind, df in tables.items():
            put(integrity.table_summary(df, TIME, [DEVICE]), f"stats/summary_{kind}", False)
            put(series.temporal_consistency(df, TIME, [DEVICE], unique_times=True), f"stats/temporal_{kind}", False)

    sources = (cfg.device_sheets, cfg.station_logs, cfg.power, cfg.weather)
    found = store.step("merged", [*sources, cfg.known_columns, cfg.time_formats, cfg.strict_logs, cfg.skip_unreadable, *limits("merged")], merging)
    layouts = {k.partition("/")[2]: df for k, df in found.items() if k.startswith("layout/")}
    keep("merged", found)

    def masking(put) -> None:
        for kind, df in stages["merged"].items():
            rules = QualityRules(cfg.ranges.get(kind, ()), cfg.constants, cfg.failures)
            station = F.concat(F.lit(f"{kind}/"), c(DEVICE))
            done = quality_control(df, rules, TIME, [DEVICE], station, store_stats=True)
            put(done.table, f"quality_controlled/{kind}")
            for name, table in done.stats.items():
                put(table, f"stats/{name}_{kind}", False)

    keep("quality_controlled", store.step("quality_controlled", [cfg.ranges, cfg.constants, cfg.failures, *limits("quality_controlled")], masking))

    def downsampling(put) -> None:
        for kind, df in stages["quality_controlled"].items():
            put(resample(df, cfg.frequency, TIME, [DEVICE]), f"downsampled/{kind}")

    if cfg.downsample:
        keep("downsampled", store.step("downsampled", [cfg.frequency, *limits("downsampled")], downsampling))

    def filling(put) -> None:
        for kind, df in stages["downsampled"].items():
            filled = put(interpolate_by_rules(df, cfg.gaps, TIME, [DEVICE], step.seconds), f"interpolated/{kind}")
            chosen = ruled_columns(df, cfg.gaps, TIME, [DEVICE])
            if chosen and cfg.gaps.mark:
                counts = interpolation_stats(filled, list(chosen), [DEVICE])
                put(counts.where("filled > 0"), f"stats/interpolation_{kind}", False)

    if interpolate:
        keep("interpolated", store.step("interpolated", [cfg.gaps, *limits("interpolated")], filling))

    tables = choose_stage(stages, cfg.downsample, interpolate)
    extracted, failed = _deliver(cfg, store, tables, layouts, stats)
    return PipelineResult(root, stages, extracted, stats, failed)


def _deliver(cfg, store: _Store, tables, layouts, stats) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Datasets and report from the tables of one stage; their statistics are added to ``stats``."""

    def keep_stats(df: DataFrame, name: str) -> DataFrame:
        stats[name] = store.write(df, f"stats/{name}", by_device=False)
        return stats[name]

    columns = {k: named_columns(layouts[k], devices) for k, devices in _named_devices(cfg.tasks, tables).items()}
    extracted = _extract_stage(cfg, store, tables, columns, keep_stats)
    return extracted, _report_stage(cfg, extracted, keep_stats) if cfg.report and extracted else {}


def _named_devices(tasks: ExtractTasks, tables: Mapping[str, DataFrame]) -> dict[str, list[str]]:
    named: dict[str, list[str]] = {}
    for specs in tasks.tasks.values():
        for spec in specs:
            kind, _, device = spec.table.partition("/")
            if kind in tables:
                named.setdefault(kind, []).extend([device, *[s.table.rpartition("/")[2] for s in spec.merge_from]])
    return named


def _extract_stage(cfg, store, tables, columns, keep_stats) -> dict[str, DataFrame]:
    """Datasets as they are delivered; planting datasets are split at the change date."""
    selected: dict[str, dict[str, DataFrame]] = {}
    delivered: dict[str, DataFrame] = {}
    for _, output, df in extract_tasks(cfg.tasks, tables, columns):
        folder, name = output.rsplit("/", 1) if "/" in output else ("", output)
        if SPLIT_TABLE_PATTERN in name:
            whole = store.write(df, f"selected/{output}", by_device=False)
            parts = extract.split_rows_by_date(whole, TIME, cfg.split_date, PART1, PART2)
            for part in (PART1, PART2):
                one = parts.where(F.col("part") == part).drop("part")
                if one.limit(1).count():
                    delivered[f"{output}_{part}"] = store.deliver(one, f"{output}_{part}", cfg.table_format)
            keep_stats(extract.split_stats(whole, TIME, cfg.split_date), f"split_{output.replace('/', '_')}")
        elif output in SPLIT_COLUMN_TABLES:
            whole = store.write(df, f"selected/{output}", by_device=False)
            halves = extract.split_columns_by_date(whole, TIME, cfg.split_date, part1=PART1, part2=PART2)
            delivered[output] = store.deliver(whole if halves is None else halves, output, cfg.table_format)
        else:
            whole = delivered[output] = store.deliver(df, output, cfg.table_format)
        selected.setdefault(folder, {})[name] = whole
    for folder, members in selected.items():
        summary = missing.task_missing_summary(members, folder, TIME, SUMMARY_HOURS.get(folder))
        keep_stats(summary, f"missing_summary_{folder.replace('/', '_').replace(' ', '_')}")
    return delivered


def _report_stage(cfg, extracted: Mapping[str, DataFrame], keep_stats) -> dict[str, str]:
    """Monthly missing rates by sensor group, as a long table and as the matrix of each report page; what failed."""
    folders: dict[str, dict[str, DataFrame]] = {}
    for output, df in extracted.items():
        folder, name = output.rsplit("/", 1) if "/" in output else ("", output)
        folders.setdefault(folder, {})[name] = df
    report = missing_rate_report(folders, TIME, change_date=cfg.split_date, per_part=cfg.sensors_per_part)
    if report.rates is None:
        raise DataProcessingError(f"no missing rates could be computed: {report.failed}")
    long = keep_stats(report.rates, "missing_rate")
    months = [r[0] for r in long.select("month").distinct().orderBy("month").collect()]  # calendar months
    page = ["group", "part", "parts", "title"]
    keep_stats(missing.missing_rate_matrix(long, months, keep=page), "missing_rate_matrix")
    keep_stats(missing.report_part_counts(long), "report_part_counts")
    return report.failed
