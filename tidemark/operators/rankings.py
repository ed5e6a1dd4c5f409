"""Most active users, regions, companies, repositories and languages.

Events are reduced to one count per user or repository before they meet the
dimension, and the dimension to its current row per key, so both join inputs
are unique on the join key whatever the skew of events or history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import is_present, region
from tidemark.operators.dims import latest_snapshot

# Fixed value: the type whose events rank users and repositories.
PUSH = "PushEvent"

# Fixed value: the word that stands for a missing location, company or language.
ABSENT = ("None",)

# Columns that rank the snapshots of one id; None for a table of current rows,
# which is joined as it is.
Order = Sequence[str] | None

USER_COLUMNS = ("login", "company", "location", "followers", "following", "public_repos")
REPO_COLUMNS = ("name", "full_name", "language")


def activity_per(
    activity: DataFrame, key: str, types: Sequence[str] | None = (PUSH,), unique: bool = False
) -> DataFrame:
    """Distinct events per ``key``; copies of an event count once.

    The distinct shuffles on (key, event id), so a hot key spreads over all
    tasks.  The fact layer holds every event once: there, ``unique`` leaves the
    distinct out and only the per-task counts are shuffled.
    """
    if types is not None:
        activity = activity.where(F.col("type").isin(*types))
    events = activity.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col("id").alias("event_id"))
    return (events if unique else events.distinct()).groupBy("id").agg(F.count("*").alias("activity_cnt"))


def _ranked(df: DataFrame, ties: Sequence[str], k: int | None) -> DataFrame:
    ordered = df.orderBy(F.col("activity_cnt").desc(), *ties)
    return ordered if k is None else ordered.limit(k)


def _with_current(counts: DataFrame, dim: DataFrame, columns: Sequence[str], order: Order) -> DataFrame:
    if order is None:
        return counts.join(dim.select("id", *columns), "id")
    # The counts are unique, so they meet the history as it is: one join, then one row per id from the same exchange.
    # Only the history of the counted ids is reduced, a small part of it for the active ids of an hour.
    history = dim.select("id", *dict.fromkeys([*order, *columns])).join(counts, "id")
    return latest_snapshot(history, order, keep=[*columns, "activity_cnt"])


def _totals(df: DataFrame, value: Column, name: str, k: int | None) -> DataFrame:
    totals = df.groupBy(value.alias(name)).agg(F.sum("activity_cnt").alias("activity_cnt"))
    return _ranked(totals, [name], k)


def active_users(counts: DataFrame, users: DataFrame, order: Order, k: int | None = None) -> DataFrame:
    """Users by activity, with their current profile; those without a public repository are left out."""
    found = _with_current(counts, users, USER_COLUMNS, order).where(F.col("public_repos") > 0)
    return _ranked(found, ["id"], k).select(*USER_COLUMNS, "activity_cnt")


def active_regions(counts: DataFrame, users: DataFrame, order: Order, k: int | None = None) -> DataFrame:
    """Activity per region, the part of the location after its last comma."""
    found = _with_current(counts, users, ["location"], order).where(is_present(F.col("location"), ABSENT))
    return _totals(found, region(F.col("location")), "location", k)


def active_companies(counts: DataFrame, users: DataFrame, order: Order, k: int | None = None) -> DataFrame:
    found = _with_current(counts, users, ["company"], order).where(is_present(F.col("company"), ABSENT))
    return _totals(found, F.col("company"), "company", k)


def active_repos(counts: DataFrame, repos: DataFrame, order: Order, k: int | None = None) -> DataFrame:
    """Repositories by activity, with their current name and language."""
    found = _with_current(counts, repos, REPO_COLUMNS, order)
    return _ranked(found, ["id"], k).select(
        F.col("id").alias("repo_id"), F.col("id").alias("act_id"), "language", "full_name", "name", "activity_cnt"
    )


def active_languages(counts: DataFrame, repos: DataFrame, order: Order, k: int | None = None) -> DataFrame:
    found = _with_current(counts, repos, ["language"], order).where(is_present(F.col("language"), ABSENT))
    return _totals(found, F.col("language"), "language", k)
