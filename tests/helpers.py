"""Small frames in and out of Spark."""

from __future__ import annotations

import math
from datetime import datetime


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def rows(df, *order):
    """Rows as tuples, ordered by the named columns."""
    return [tuple(r) for r in df.orderBy(*order).collect()]


def same(a, b, tolerance=1e-9) -> bool:
    if a is None or b is None or (isinstance(b, float) and math.isnan(b)):
        return a is None and (b is None or math.isnan(b))
    return abs(a - b) <= tolerance
