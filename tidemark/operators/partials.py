"""Counts that add up: what a load contributes to the counts over all history.

A load is counted once, when it is split.  The counts of any set of loads are the sums of their
partial counts, so results over all history read these and no old event.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import floor_hour
from tidemark.operators.events import EVENT_COUNTS, hourly_change
from tidemark.operators.hours import stamp_hour


def hour_partials(facts: DataFrame) -> DataFrame:
    """``hour, type, events`` of a load; a record without a time has the hour NULL."""
    return facts.groupBy(floor_hour(F.col("ts")).alias("hour"), "type").agg(F.count("*").alias("events"))


def key_partials(facts: DataFrame, key: str) -> DataFrame:
    """``key, type, events`` of a load."""
    return facts.groupBy(key, "type").agg(F.count("*").alias("events"))


def all_count(hours: DataFrame, hour: DataFrame, counts: Mapping[str, str] = EVENT_COUNTS) -> DataFrame:
    """One wide row of counts over all loads; same columns as ``event_all_count``."""
    found = [F.coalesce(F.sum(F.when(F.col("type") == t, F.col("events"))), F.lit(0).cast("long")).alias(n) for n, t in counts.items()]
    return stamp_hour(hours.agg(*found), hour)


def hour_count(hours: DataFrame, hour: DataFrame) -> DataFrame:
    """The same within the data hour."""
    return all_count(hours.where(F.col("hour") == hour.scalar()), hour)


def trend(hours: DataFrame) -> DataFrame:
    """Hourly count per type and its change, over all loads."""
    return hourly_change(hours.groupBy("hour", "type").agg(F.sum("events").alias("events")))


def counts_per(partials: DataFrame, key: str, types: Sequence[str] | None = None, name: str | None = None) -> DataFrame:
    """``activity_cnt`` per key over all loads; of some types, then without the events that have no key."""
    if types is not None:
        partials = partials.where(F.col("type").isin(*types) & F.col(key).isNotNull())
    return partials.groupBy(F.col(key).alias(name or key)).agg(F.sum("events").alias("activity_cnt"))


def loads_of_hours(hours: DataFrame, incoming: DataFrame) -> DataFrame:
    """The loads, as ``load_id``, that hold events of the hours of the incoming ones.

    An event never changes its time, so no other load can hold one of them.
    """
    wanted = incoming.select(floor_hour(F.col("ts")).alias("wanted")).distinct()
    return hours.join(wanted, F.col("hour").eqNullSafe(F.col("wanted")), "left_semi").select("load_id").distinct()
