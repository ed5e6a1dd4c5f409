"""Event counts, ratios and trends; each is one pass over the activity."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.stats import percent
from tidemark.functions.time import floor_hour
from tidemark.operators.hours import stamp_hour, within_hour

# Result columns of the event counts and the type each counts.
EVENT_COUNTS = {
    "createEventCount": "CreateEvent",
    "deleteEventCount": "DeleteEvent",
    "issuesEventCount": "IssuesEvent",
    "issueCommentEventCount": "IssueCommentEvent",
    "pullEventCount": "PullRequestEvent",
    "pushEventCount": "PushEvent",
    "releaseEventCount": "ReleaseEvent",
    "watchEventCount": "WatchEvent",
}

# Result columns of the event ratios and the count behind each.
EVENT_RATIOS = {
    "createEventRatio": "createEventCount",
    "deleteEventRatio": "deleteEventCount",
    "issuesEventRatio": "issuesEventCount",
    "issueCommentEventRatio": "issueCommentEventCount",
    "pullRequestEventRatio": "pullEventCount",
    "pushEventRatio": "pushEventCount",
    "releaseEventRatio": "releaseEventCount",
    "watchEventRatio": "watchEventCount",
}


def count_types(activity: DataFrame, counts: Mapping[str, str] = EVENT_COUNTS) -> DataFrame:
    """One wide row, one conditional count per type; each task sends one row."""
    return activity.agg(*[F.count_if(F.col("type") == t).alias(name) for name, t in counts.items()])


def event_all_count(activity: DataFrame, hour: DataFrame) -> DataFrame:
    return stamp_hour(count_types(activity), hour)


def event_count(activity: DataFrame, hour: DataFrame, date: str | None = None) -> DataFrame:
    """Counts within the data hour; see :func:`within_hour` for ``date``."""
    return stamp_hour(count_types(activity.where(within_hour(hour, date=date))), hour)


def event_ratio(counts: DataFrame) -> DataFrame:
    """Share of every type in percent, from a row of counts."""
    total: Column = sum((F.col(name) for name in EVENT_RATIOS.values()), F.lit(0))
    shares = [percent(F.col(count), total).alias(name) for name, count in EVENT_RATIOS.items()]
    return counts.select(*shares, "created_at")


def event_trend(activity: DataFrame) -> DataFrame:
    """Hourly count per type and its change from the previous hour seen.

    The window runs over the aggregate: one row per type and hour, so a
    partition grows with the calendar and not with the events.
    """
    hourly = activity.groupBy(floor_hour(F.col("ts")).alias("hour"), "type").agg(
        F.count("*").alias("events")
    )
    return hourly_change(hourly)


def hourly_change(hourly: DataFrame) -> DataFrame:
    """``hour, type, events`` with the change from the previous hour of the type."""
    previous = F.lag("events").over(W.partitionBy("type").orderBy("hour"))
    return hourly.withColumn("change", F.col("events") - previous)


def recent(
    activity: DataFrame, minutes: int = 20, hour: DataFrame | None = None, date: str | None = None
) -> DataFrame:
    """Records newer than ``minutes`` before the newest one.

    The newest time is looked for in the whole activity, or in the data hour
    where that is known; ``date`` names a partition column, to read the days
    from the cutoff on only.
    """
    newest = activity if hour is None else activity.where(within_hour(hour, date=date))
    cutoff = newest.agg((F.max("ts") - F.make_interval(mins=F.lit(minutes))).alias("cutoff")).scalar()
    found = activity.where(F.col("ts") > cutoff)
    return found if date is None else found.where(F.col(date) >= F.to_date(cutoff))


def count_by(activity: DataFrame, key: str) -> DataFrame:
    """Events per user or repository; counted before the shuffle, so a hot key is one row per task."""
    return activity.groupBy(key).agg(F.count("*").alias("activity_cnt"))


def dim_count(dim: DataFrame, name: str) -> DataFrame:
    """Number of distinct entities in a dimension that keeps every snapshot."""
    return dim.agg(F.count_distinct("id").alias(name))
