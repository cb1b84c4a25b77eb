"""Directions in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def direction(mean_sin: Column, mean_cos: Column) -> Column:
    """Angle of a mean vector in [0, 360); NULL for no vector."""
    angle = F.degrees(F.atan2(mean_sin, mean_cos))
    return F.when(angle < 0, angle + 360).otherwise(angle)
