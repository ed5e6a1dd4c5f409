"""Raw activity split into eight fact shapes, the issue dimension and the time dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import day_key, hour_key, parse_utc
from tidemark.schemas import ISSUE_PAYLOAD


@dataclass(frozen=True)
class FactSpec:
    """One fact table: the record type it holds and its payload columns."""

    event_type: str
    payload: tuple[str, ...]


# Fact tables with their record type and payload columns.
FACT_SPECS = {
    "createTable": FactSpec(
        "CreateEvent",
        ("payload_ref", "payload_ref_type", "payload_master_branch", "payload_description", "payload_pusher_type"),
    ),
    "deleteTable": FactSpec("DeleteEvent", ("payload_ref", "payload_ref_type", "payload_pusher_type")),
    "issuesTable": FactSpec("IssuesEvent", ("payload_action", "payload_issue_id")),
    "issueCommentTable": FactSpec("IssueCommentEvent", ("payload_action", "payload_issue_id")),
    "pullTable": FactSpec("PullRequestEvent", ("payload_action", "payload_number")),
    "pushTable": FactSpec("PushEvent", ("payload_push_id", "payload_size", "payload_distinct_size")),
    "releaseTable": FactSpec("ReleaseEvent", ("payload_action", "payload_release_id")),
    "watchTable": FactSpec("WatchEvent", ("payload_action",)),
}

# Payload columns that are the id of a nested object, and that object's key.
NESTED_IDS = {"payload_issue_id": "issue", "payload_release_id": "release"}

# Payload columns holding whole numbers.
NUMERIC = {
    "payload_issue_id", "payload_number", "payload_push_id", "payload_size",
    "payload_distinct_size", "payload_release_id",
}

PAYLOAD_COLUMNS = tuple(dict.fromkeys(name for spec in FACT_SPECS.values() for name in spec.payload))
FACT_TYPES = tuple(spec.event_type for spec in FACT_SPECS.values())


def _payload_value(name: str) -> Column:
    if name in NESTED_IDS:
        value = F.get_json_object(F.col("payload")[NESTED_IDS[name]], "$.id")
    else:
        value = F.col("payload")[name.removeprefix("payload_")]
    return value.try_cast("bigint") if name in NUMERIC else value


def _payload_column(name: str) -> Column:
    """Value on the record types that own the column, NULL on the others."""
    owners = [spec.event_type for spec in FACT_SPECS.values() if name in spec.payload]
    return F.when(F.col("type").isin(owners), _payload_value(name))


def is_fact() -> Column:
    return F.col("type").isin(list(FACT_TYPES))


def fact_columns(ts: Column | None = None) -> list[Column]:
    """Columns of the fact layer, of a raw record of a known type; ``ts`` is its time, where it is parsed already."""
    ts = parse_utc(F.col("created_at")) if ts is None else ts
    return [
        F.col("id"),
        F.col("type"),
        F.col("actor")["id"].try_cast("bigint").alias("actor_id"),
        F.col("repo")["id"].try_cast("bigint").alias("repo_id"),
        *[_payload_column(name).alias(name) for name in PAYLOAD_COLUMNS],
        hour_key(ts).alias("time"),
        ts.alias("ts"),
        F.to_date(ts).alias("event_date"),
    ]


def split_facts(raw: DataFrame) -> DataFrame:
    """All eight facts in one scan: one wide row per record of a known type.

    Written with ``partitionBy("event_date", "type")`` this is the fact layer;
    :func:`fact` reads one table of it with partition pruning.
    """
    return raw.where(is_fact()).select(*fact_columns())


def fact(facts: DataFrame, table: str) -> DataFrame:
    """One fact table out of the wide layer, with its own columns only."""
    spec = FACT_SPECS[table]
    return facts.where(F.col("type") == spec.event_type).select(
        "id", "type", "actor_id", "repo_id", *spec.payload, "time"
    )


ISSUE_COLUMNS = ("id", "state_reason", "state", "comments", "number", "start_time", "end_time")


def issue_snapshots(raw: DataFrame) -> DataFrame:
    """One row per issue record: the state of the issue at that moment.

    ``event_id`` and ``event_date`` identify the record, for a repeatable load;
    ``event_time`` orders the snapshots of an issue.
    """
    return raw.where(is_issue()).select("id", "created_at", issue_record().alias("issue")).select(*issue_columns())


def is_issue() -> Column:
    return F.col("type") == "IssuesEvent"


def issue_record() -> Column:
    """The issue of a raw record, parsed once for all its columns."""
    return F.from_json(F.col("payload")["issue"], ISSUE_PAYLOAD)


def issue_columns(ts: Column | None = None) -> list[Column]:
    """Columns of an issue snapshot, of a record whose ``issue`` is parsed, and its time ``ts`` too, if given."""
    ts = parse_utc(F.col("created_at")) if ts is None else ts
    return [
        F.col("id").alias("event_id"),
        F.col("issue.id").try_cast("bigint").alias("id"),
        F.col("issue.state_reason").alias("state_reason"),
        F.col("issue.state").alias("state"),
        F.col("issue.comments").try_cast("bigint").alias("comments"),
        F.col("issue.number").try_cast("bigint").alias("number"),
        parse_utc(F.col("issue.created_at")).alias("start_time"),
        parse_utc(F.col("issue.closed_at")).alias("end_time"),
        ts.alias("event_time"),
        F.to_date(ts).alias("event_date"),
    ]


def issue_dim(raw: DataFrame) -> DataFrame:
    """The seven columns of the issue dimension."""
    return issue_snapshots(raw).select(*ISSUE_COLUMNS)


def time_dim(raw: DataFrame, loaded_at: float) -> DataFrame:
    """One row per load: when it ran and the newest data hour it saw."""
    return time_row(raw.select(parse_utc(F.col("created_at")).alias("ts")), loaded_at)


def time_row(times: DataFrame, loaded_at: float) -> DataFrame:
    """The same from parsed times (``ts``)."""
    newest = times.agg(F.max("ts").alias("ts")).where(F.col("ts").isNotNull())
    return newest.select(
        F.lit(loaded_at).cast("double").alias("timestamp_d"),
        hour_key(F.col("ts")).alias("time_hour"),
        day_key(F.col("ts")).alias("time_day"),
    )
