"""Arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``, rounded half up; NULL for an empty whole."""
    return F.round(F.try_divide(part, whole) * F.lit(100.0), digits)
