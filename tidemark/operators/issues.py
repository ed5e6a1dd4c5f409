"""Issue statistics and histograms; one scan each, fixed columns even for no rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.buckets import interval_label, interval_names, level_label, level_names
from tidemark.operators.dims import latest_snapshot
from tidemark.operators.hours import stamp_hour


#: What orders the snapshots of an issue in the warehouse.
ISSUE_ORDER = ("event_time", "event_id")


def current_issues(snapshots: DataFrame, order: Sequence[str] = ISSUE_ORDER) -> DataFrame:
    """The latest snapshot of every issue; the statistics below then count issues and not records."""
    return latest_snapshot(snapshots, order).drop(*order)


def issue_basic(issues: DataFrame, hour: DataFrame) -> DataFrame:
    """Counts by state and by state reason.

    ``issueOtherClosedCount`` is every known reason but ``completed``, whatever
    the state, so it includes the reopened ones; unknown reasons are not counted.
    """
    state, reason = F.col("state"), F.col("state_reason")
    counts = issues.agg(
        F.count_if(state == "open").alias("issueOpenCount"),
        F.count_if(state == "closed").alias("issueClosedCount"),
        F.count_if(reason == "reopened").alias("issueReopenedCount"),
        F.count_if(reason == "completed").alias("issueCompletedCount"),
        F.count_if(reason != "completed").alias("issueOtherClosedCount"),
    )
    return stamp_hour(counts, hour)


def issue_state_breakdown(issues: DataFrame) -> DataFrame:
    """Count per state, and per reason within the closed ones (``by_reason``), in one scan."""
    sets = [[F.col("state")], [F.col("state"), F.col("state_reason")]]
    grouped = issues.groupingSets(sets, "state", "state_reason").agg(
        F.count("*").alias("issues"), (F.grouping("state_reason") == 0).alias("by_reason")
    )
    return grouped.where(~F.col("by_reason") | (F.col("state") == "closed"))


def issue_comment_freq(issues: DataFrame) -> DataFrame:
    """Number of issues per comment count, ascending."""
    comments = F.col("comments").try_cast("bigint")
    return (
        issues.groupBy(comments.alias("comments")).agg(F.count("*").alias("issues")).orderBy("comments")
    )


def _histogram(labels: DataFrame, names: list[str], *extra: Column) -> DataFrame:
    return labels.agg(*[F.count_if(F.col("label") == name).alias(name) for name in names], *extra)


def issue_interval_hist(issues: DataFrame, hour: DataFrame) -> DataFrame:
    """Closed issues by days from opening to closing, and the longest of them."""
    days = F.datediff("end_time", "start_time")
    closed = issues.where(F.col("state") == "closed").select(
        days.alias("days"), interval_label(days).alias("label")
    )
    longest = F.max("days").alias("issueMaxInterval")
    return stamp_hour(_histogram(closed, interval_names(), longest), hour)


def _level_hist(issues: DataFrame, column: str, prefix: str, hour: DataFrame) -> DataFrame:
    value = F.col(column).try_cast("bigint")
    labels = issues.select(level_label(value, prefix).alias("label"))
    return stamp_hour(_histogram(labels, level_names(prefix)), hour)


def issue_comments_hist(issues: DataFrame, hour: DataFrame) -> DataFrame:
    return _level_hist(issues, "comments", "C", hour)


def issue_number_hist(issues: DataFrame, hour: DataFrame) -> DataFrame:
    return _level_hist(issues, "number", "N", hour)
