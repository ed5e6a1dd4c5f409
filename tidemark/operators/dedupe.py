"""Idempotent event loading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dims import first_snapshot, insert_new


def dedupe_events(events: DataFrame, key: str = "id", order: Sequence[str] | None = None) -> DataFrame:
    """One row per event id: the first by ``order``, by default over all other columns.

    Copies collapse in a partial aggregate before the shuffle, so an id copied
    any number of times still sends one row per task.  Records without an id
    are copies of each other only where all columns are equal.
    """
    order = order or [name for name in events.columns if name != key]
    named = first_snapshot(events.where(F.col(key).isNotNull()), order, key).select(*events.columns)
    return named.unionAll(events.where(F.col(key).isNull()).distinct())


def rejected(landed: DataFrame, key: str = "id", broken: str = "broken") -> DataFrame:
    """Landed lines that are no events, as ``(reason, value)``: broken text, or a record without id."""
    return landed.select(*reject_columns(landed.columns, key, broken)).where("reason is not null")


def reject_columns(columns: Sequence[str], key: str = "id", broken: str = "broken") -> list[Column]:
    """``reason, value`` of a landed record, both NULL for an event."""
    record = F.to_json(F.struct(*[c for c in columns if c not in (broken, "event_date")]))
    reason = F.when(F.col(broken).isNotNull(), "broken").when(F.col(key).isNull(), "no id")
    return [reason.alias("reason"), F.when(reason.isNotNull(), F.coalesce(broken, record)).alias("value")]


def new_events(incoming: DataFrame, stored: DataFrame, key: str = "id", date: str = "event_date") -> DataFrame:
    """Incoming events not stored yet, for an append that can be repeated.

    An event never changes its date, so only the stored partitions between the
    first and last incoming date are read, and the one for unknown dates.
    """
    first = incoming.agg(F.min(date)).scalar()
    last = incoming.agg(F.max(date)).scalar()
    window = stored.where(F.col(date).between(first, last) | F.col(date).isNull())
    # Without an id nothing tells a repeated record from another one: such records are rejected, not appended.
    return insert_new(dedupe_events(incoming.where(F.col(key).isNotNull()), key), window, [key])


def distinct_activity(activity: DataFrame) -> DataFrame:
    """Distinct ``(id, actor_id, repo_id)``; the basis of the activity rankings."""
    return activity.select("id", "actor_id", "repo_id").distinct()
