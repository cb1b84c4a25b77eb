"""Sensor names for reports, as string expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ordered replacements that shorten a sensor name.
ABBREVIATIONS = (
    ("(Changed to Sedum lineare)", "Changed"),
    ("(No Change)", "NoChange"),
    ("Temperature", "Temp"),
    ("Humidity", "RH"),
    ("WindSpeed", "Ws"),
    ("WindDirection", "Wdir"),
    ("Radiation", "Rad"),
    ("_200cm", " SH200"),
    ("_180cm", " SH180"),
    ("_050cm", " SH050"),
    ("_090cm", " Hgt090"),
    ("_060cm", " Hgt060"),
    ("_075cm", " Hgt075"),
    ("PVHgt_", ""),
    ("_PVHgt", ""),
)

# Marks taken out of a file name before it becomes a column prefix, in order.
PREFIX_NOISE = ("_yr", "_1yr")


def abbreviate(name: Column) -> Column:
    """Shortened name: replacements in order, runs of ``_`` made one, repeated neighbours dropped."""
    for old, new in ABBREVIATIONS:
        name = F.replace(name, F.lit(old), F.lit(new))
    parts = F.split(F.regexp_replace(name, "_+", "_"), "_", -1)
    kept = F.filter(parts, lambda part, i: (i == 0) | (part != F.get(parts, i - 1)))
    return F.array_join(kept, "_")


def wrap(name: Column, max_length: int = 30) -> Column:
    """Lines broken at ``_``, filled greedily up to ``max_length`` characters."""
    room = F.lit(max_length)
    start = F.struct(F.lit("").alias("text"), F.lit(-1).alias("used"))

    def place(state: Column, part: Column) -> Column:
        width = F.length(part)
        first = state["used"] < 0
        fits = state["used"] + 1 + width <= room
        joint = F.when(first, "").when(fits, "_").otherwise("\n")
        used = F.when(~first & fits, state["used"] + 1 + width).otherwise(width)
        return F.struct(F.concat(state["text"], joint, part).alias("text"), used.alias("used"))

    return F.aggregate(F.split(name, "_", -1), start, place, lambda state: state["text"])


def title(name: Column) -> Column:
    """``soil_moisture`` as ``Soil Moisture``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def file_prefix(stem: str) -> str:
    for noise in PREFIX_NOISE:
        stem = stem.replace(noise, "")
    return stem


def file_prefix_expr(stem: Column) -> Column:
    """:func:`file_prefix` of a column of names."""
    for noise in PREFIX_NOISE:
        stem = F.replace(stem, F.lit(noise), F.lit(""))
    return stem
