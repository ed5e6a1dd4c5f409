"""The data hour that results are stamped with and restricted to.

An *hour frame* is one row with one column ``created_at``.  It is attached as
a scalar subquery, never joined: nothing is broadcast, and a comparison with
the event time is pushed to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import floor_hour, parse_hour_key


def latest_hour(activity: DataFrame, ts: str = "ts") -> DataFrame:
    """Hour of the newest record; reads the time column alone."""
    return activity.agg(floor_hour(F.max(ts)).alias("created_at"))


def latest_loaded_hour(times: DataFrame) -> DataFrame:
    """Hour of the newest load, from the time dimension (one row per load)."""
    key = F.max_by("time_hour", F.struct("timestamp_d", "time_hour"))
    return times.agg(parse_hour_key(key).alias("created_at"))


def within_hour(hour: DataFrame, ts: str = "ts", date: str | None = None) -> Column:
    """Records of the hour; ``date`` names a partition column, to read that day's files only."""
    start = hour.scalar()
    inside = (F.col(ts) >= start) & (F.col(ts) < start + F.expr("INTERVAL 1 HOUR"))
    return inside if date is None else inside & (F.col(date) == F.to_date(start))


def stamp_hour(df: DataFrame, hour: DataFrame) -> DataFrame:
    """Append the data hour as ``created_at``."""
    return df.withColumn("created_at", hour.scalar())


def stamp_run(df: DataFrame, as_of) -> DataFrame:
    """Append the run time as ``updated_at``; an argument, so a rerun is reproducible."""
    return df.withColumn("updated_at", F.lit(as_of).cast("timestamp_ntz"))
