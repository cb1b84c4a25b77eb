"""Rule files as dataclasses: ranges, constant runs, failure windows, gap filling, extraction tasks.

Rules decide which columns a plan touches, so they live in the driver; only a failure-window table
grows with the number of stations and can also be turned into a DataFrame.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from stationloom.errors import ConfigurationError, ValidationError

# Kinds of data a range rule file may describe.
DATA_TYPES = ("microclimate", "power", "weather")

# Keys of an extraction file that are not tasks.
EXTRACTION_METADATA = ("description", "input_directory", "interpolated_directory", "output_directory", "settings")

# Failure windows used when there is no failure file.
FALLBACK_FAILURES = {
    "microclimate/dev9010D231200001.csv": {
        "start": "2024-07-28",
        "end": "2024-10-16",
        "sensors": ["Humi_", "Met_", "TC", "Temp_"],
    },
    "microclimate/dev9010D231200002.csv": {
        "start": "2024-07-31",
        "end": "2025-02-10",
        "sensors": ["Humi_", "Met_", "TC", "Temp_"],
    },
}


@dataclass(frozen=True)
class DayNight:
    """Lower bounds by time of day; day is ``start_hour <= hour < end_hour``."""

    start_hour: int
    end_hour: int
    day_lower: float
    night_lower: float
    night_upper: float | None = None


@dataclass(frozen=True)
class RangeRule:
    variable: str
    lower: float
    upper: float
    patterns: tuple[str, ...]
    unit: str = ""
    description: str = ""
    day_night: DayNight | None = None

    @property
    def bounds_text(self) -> str:
        plain = f"{self.lower} to {self.upper} {self.unit}"
        d = self.day_night
        if d is None:
            return plain
        night_upper = self.upper if d.night_upper is None else d.night_upper
        return (
            f"Daytime ({d.start_hour:02d}:00-{d.end_hour:02d}:00): {d.day_lower} to {self.upper} {self.unit}, "
            f"Nighttime: {d.night_lower} to {night_upper} {self.unit}"
        )

    @property
    def plain_bounds_text(self) -> str:
        return f"{self.lower} to {self.upper} {self.unit}"


@dataclass(frozen=True)
class ConstantRule:
    category: str
    patterns: tuple[str, ...]
    window_days: int = 1
    tolerance: float = 1e-6


@dataclass(frozen=True)
class FailureWindow:
    """Station key, closed window with midnight bounds, and parts of the sensor names that failed."""

    station: str
    start: str
    end: str
    sensors: tuple[str, ...]


@dataclass(frozen=True)
class GapRule:
    data_type: str
    patterns: tuple[str, ...]
    method: str = "linear"


@dataclass(frozen=True)
class GapRules:
    enabled: bool = True
    limit_rows: int | None = 60
    mark: bool = True
    rules: tuple[GapRule, ...] = ()


@dataclass(frozen=True)
class ExtractSource:
    table: str
    columns: Mapping[str, str]


@dataclass(frozen=True)
class ExtractFile:
    table: str
    output: str
    columns: Mapping[str, str] | None = None
    start: str | None = None
    end: str | None = None
    merge_from: tuple[ExtractSource, ...] = ()


@dataclass(frozen=True)
class ExtractTasks:
    tasks: Mapping[str, tuple[ExtractFile, ...]] = field(default_factory=dict)
    start: str | None = None
    end: str | None = None


def require_keys(config: Any, keys: Sequence[str], name: str = "configuration") -> Mapping[str, Any]:
    """A mapping that has all the keys."""
    if not isinstance(config, Mapping):
        raise ConfigurationError(f"{name} must be a mapping, got {type(config).__name__}")
    missing = [k for k in keys if k not in config]
    if missing:
        raise ConfigurationError(f"{name} lacks {', '.join(missing)}; it has {', '.join(map(str, config))}")
    return config


def _read_json(path: str) -> Any:
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except FileNotFoundError as e:
        raise ConfigurationError(f"rule file not found: {path}") from e
    except json.JSONDecodeError as e:
        raise ConfigurationError(f"rule file {path} is not valid JSON: {e}") from e


def range_rules(config: Mapping[str, Any], data_type: str) -> list[RangeRule]:
    if data_type not in DATA_TYPES:
        raise ValidationError(f"data type {data_type!r} is not one of {', '.join(DATA_TYPES)}")
    rules = []
    for variable, entry in config.get(data_type, {}).items():
        require_keys(entry, ("lower_bound", "upper_bound", "applies_to"), f"range rule {variable}")
        timed = entry.get("time_dependent", {})
        day_night = None
        if timed.get("enabled", False):
            day, night = timed["daytime"], timed["nighttime"]
            start, end = day["hours"]
            day_night = DayNight(start, end, day["lower_bound"], night["lower_bound"], night.get("upper_bound"))
        rules.append(
            RangeRule(
                variable, entry["lower_bound"], entry["upper_bound"], tuple(entry["applies_to"]),
                entry.get("unit", ""), entry.get("description", ""), day_night,
            )
        )
    return rules


def load_range_rules(path: str, data_type: str) -> list[RangeRule]:
    return range_rules(_read_json(path), data_type)


def range_rule_info(rules: Sequence[RangeRule]) -> dict[str, dict[str, Any]]:
    """Description, range text and patterns per variable."""
    return {
        r.variable: {"description": r.description, "range": r.plain_bounds_text, "patterns": list(r.patterns)}
        for r in rules
    }


def constant_rules(config: Mapping[str, Any]) -> list[ConstantRule]:
    if not config or not config.get("enabled", True):
        return []
    window, tolerance = config.get("window_days", 1), config.get("tolerance", 1e-6)
    return [
        ConstantRule(
            category, tuple(entry.get("patterns", ())), entry.get("window_days", window),
            entry.get("tolerance", tolerance),
        )
        for category, entry in config.get("applies_to", {}).items()
        if entry.get("enabled", True)
    ]


def load_constant_rules(path: str) -> list[ConstantRule]:
    """No file means that constant runs are not looked for; a file that is no rule file is an error."""
    if not os.path.exists(path):
        return []
    return constant_rules(_read_json(path))


def failure_windows(config: Mapping[str, Any]) -> list[FailureWindow]:
    return [
        FailureWindow(station.removesuffix(".csv"), entry["start"], entry["end"], tuple(entry["sensors"]))
        for station, entry in config.items()
    ]


def load_failure_windows(path: str) -> list[FailureWindow]:
    try:
        config = _read_json(path).get("sensor_failures", {})
    except ConfigurationError as e:
        # only a missing file has a fallback; a broken one switches failure masking off
        config = FALLBACK_FAILURES if isinstance(e.__cause__, FileNotFoundError) else {}
    return failure_windows(config)


def gap_rules(config: Mapping[str, Any]) -> GapRules:
    settings = config.get("settings", {})
    rules = tuple(
        GapRule(data_type, tuple(entry.get("applies_to", ())), entry.get("method", "linear"))
        for data_type, entry in config.get("data_types", {}).items()
        if entry.get("enabled", False)
    )
    return GapRules(
        config.get("enabled", False), settings.get("max_gap_minutes") or None,
        settings.get("mark_interpolated", True), rules,
    )


def load_gap_rules(path: str) -> GapRules:
    return gap_rules(_read_json(path))


def extract_tasks(config: Mapping[str, Any], tasks: Sequence[str] | None = None) -> ExtractTasks:
    available = [k for k in config if k not in EXTRACTION_METADATA]
    unknown = [t for t in tasks or () if t not in available]
    if unknown:
        raise ConfigurationError(f"unknown extraction task {unknown}; available: {available}")
    dates = config.get("settings", {}).get("date_range", {})

    def source(entry: Mapping[str, Any]) -> ExtractSource:
        return ExtractSource(entry["input"].removesuffix(".csv"), entry["columns"])

    def one(entry: Mapping[str, Any]) -> ExtractFile:
        own, merge = entry.get("date_range", {}), entry.get("merge_from") or []
        columns = entry.get("columns")
        return ExtractFile(
            entry["input"].removesuffix(".csv"), entry["output"].removesuffix(".csv"),
            None if columns == "all" else columns, own.get("start_date"), own.get("end_date"),
            tuple(source(m) for m in (merge if isinstance(merge, list) else [merge])),
        )

    return ExtractTasks(
        {t: tuple(one(e) for e in config[t]["files"]) for t in (tasks or available)},
        dates.get("start_date"), dates.get("end_date"),
    )


def load_extract_tasks(path: str, tasks: Sequence[str] | None = None) -> ExtractTasks:
    return extract_tasks(_read_json(path), tasks)


def list_tasks(path: str) -> list[str]:
    return [k for k in _read_json(path) if k not in EXTRACTION_METADATA]
