"""Streaming queries over the provided tables, run to the end of the input."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.bindings import views as V
from tidemark.operators.text import word_count
from tidemark.session import new_run_dir
from tidemark.sources import folders
from tidemark.sources.files import tail_table
from tidemark.streaming import once, records, writers


def _tail(s: SparkSession, d: str, name: str) -> DataFrame:
    return tail_table(s, f"{d}/{name}.parquet", V.table(s, d, name).schema)


def _log(s: SparkSession, d: str) -> DataFrame:
    """Events as the records of a message log: a binary ``value`` per record."""
    activity = V.spark_view(s, "activity", events=_tail(s, d, "events"))
    return V.activity_lines(activity).select(F.col("value").cast("binary").alias("value"))


def _run(stream: DataFrame, path: str, **options) -> DataFrame:
    query = writers.write_batches(stream, f"{path}/out", f"{path}/checkpoint", **options)
    query.awaitTermination()
    schema = options["each"](stream).schema if options.get("each") else stream.schema
    return writers.read_batches(stream.sparkSession, f"{path}/out", schema)


def parse_flatten(s: SparkSession, d: str) -> DataFrame:
    flat = records.flatten_records(records.parse_records(_log(s, d)))
    return _run(flat, new_run_dir(s, "parse-flatten")).drop(writers.BATCH)


def event_window_count(s: SparkSession, d: str) -> DataFrame:
    flat = records.flatten_records(records.parse_records(_log(s, d)))
    batches = _run(records.window_counts(flat), new_run_dir(s, "window-count"), mode="update")
    return writers.newest_per_key(batches, ["window_start", "window_end", "type"], "events")


def event_running_count(s: SparkSession, d: str) -> DataFrame:
    flat = records.flatten_records(records.parse_records(_log(s, d)))
    batches = _run(records.type_counts(flat), new_run_dir(s, "running-count"), mode="update")
    return writers.newest_per_key(batches, "type", "events")


def batch_count(s: SparkSession, d: str) -> DataFrame:
    flat = records.flatten_records(records.parse_records(_log(s, d)))
    batches = _run(flat, new_run_dir(s, "batch-count"), each=records.type_counts)
    return batches.groupBy("type").agg(F.sum("events").alias("events"))


def stream_counts_compacted(s: SparkSession, d: str) -> DataFrame:
    """Running counts over a dozen batches whose folders are folded into snapshots on the way."""
    path = new_run_dir(s, "compacted")
    activity = V.view(s, d, "activity")
    activity.withColumn("part", F.pmod(F.dayofmonth("ts"), F.lit(12))).repartition("part").write.partitionBy("part").parquet(f"{path}/in")
    stream = s.readStream.schema(activity.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    fold = writers.newest_rows("type")
    batches = _run(records.type_counts(stream), path, mode="update", fold=fold, fold_after=5)
    return writers.newest_per_key(batches, "type", "events")


def stream_dedupe(s: SparkSession, d: str) -> DataFrame:
    """Events that come in many batches, many of them twice and half of them days late: every one is appended once."""
    path = new_run_dir(s, "stream-once")
    activity = V.view(s, d, "activity")
    days, ids = F.coalesce(F.pmod(F.dayofmonth("ts"), F.lit(3)), F.lit(0)), F.coalesce(F.pmod(F.col("id"), F.lit(2)), F.lit(0))
    parts = [days == i for i in range(3)] + [ids == i for i in range(2)]
    # One part after the other, which is the order of the batches; a part has a file for each task that has rows of it.
    for part in parts:
        activity.where(part).write.mode("append").parquet(f"{path}/in")
    files = max(1, math.ceil(len(folders.tree(s, f"{path}/in")) / len(parts)))

    def source() -> DataFrame:
        return s.readStream.schema(activity.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/in")

    for _ in range(2):
        once.append_once(source, f"{path}/out", f"{path}/checkpoint")
    return once.read_once(s, f"{path}/out", activity.schema)


def stream_word_count(s: SparkSession, d: str) -> DataFrame:
    counted = word_count(_tail(s, d, "conversations"), "text")
    return writers.newest_per_key(_run(counted, new_run_dir(s, "word-count"), mode="update"), "word", "words")


def ingest_files_once(s: SparkSession, d: str) -> DataFrame:
    """Land the events by day; a second round finds nothing new and adds nothing."""
    path = new_run_dir(s, "ingest")
    for _ in range(2):
        dated = _tail(s, d, "events").withColumn("event_date", F.to_date("ts"))
        writers.land_files(dated, f"{path}/out", f"{path}/checkpoint", ("event_date",)).awaitTermination()
    return s.read.parquet(f"{path}/out").select("event_id", "ts", "user_id", "event_type", "event_date")


QUERIES = {
    "ingest_files_once": ingest_files_once,
    "stream_parse_flatten": parse_flatten,
    "stream_event_window_count": event_window_count,
    "stream_event_running_count": event_running_count,
    "stream_batch_count": batch_count,
    "stream_dedupe": stream_dedupe,
    "stream_counts_compacted": stream_counts_compacted,
    "stream_word_count": stream_word_count,
}
