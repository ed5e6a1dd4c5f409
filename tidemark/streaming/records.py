"""Streaming transformations; each also works on a batch frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import parse_utc
from tidemark.schemas import STREAM_EVENT


def parse_records(log: DataFrame) -> DataFrame:
    """Log records (binary ``value``) as nested activity."""
    return log.select(F.from_json(F.col("value").cast("string"), STREAM_EVENT).alias("data"))


# Columns of a flat record and the member of the nested one that each holds.
FLAT = {
    "id": "id", "type": "type", "actor_id": "actor.id", "actor_login": "actor.login", "repo_id": "repo.id",
    "repo_name": "repo.name", "repo_url": "repo.url",
}


def flatten_records(parsed: DataFrame) -> DataFrame:
    """Nested activity as flat rows: actor, repository and event time pulled up."""
    columns = [F.col(f"data.{member}").alias(name) for name, member in FLAT.items()]
    return parsed.select(*columns, parse_utc(F.col("data.created_at")).alias("ts"))


def window_counts(events: DataFrame, window: str = "1 hour", lateness: str = "1 minute") -> DataFrame:
    """Events per type and tumbling window.

    In update mode every batch gives the windows it changed, open ones too; in
    append mode a window is given once the watermark has passed its end.  The
    state holds only the open windows; later records of a closed one are dropped.
    """
    timed = events.select(F.col("ts").cast("timestamp").alias("ts"), "type")
    counted = (
        timed.withWatermark("ts", lateness)
        .groupBy(F.window("ts", window), "type")
        .agg(F.count("*").alias("events"))
    )
    return counted.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        "type",
        "events",
    )


def type_counts(events: DataFrame) -> DataFrame:
    """Events per type: running totals on a stream, plain counts on a batch."""
    return events.groupBy("type").agg(F.count("*").alias("events"))
