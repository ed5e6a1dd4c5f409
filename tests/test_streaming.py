"""Streams: late rows, restarts, several batches, the same result as a batch."""

import json
import os
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.bindings import live
from tidemark.operators.text import word_count
from tidemark.session import new_run_dir, shared_dir
from tidemark.sinks.publish import FileTarget
from tidemark.sources import folders
from tidemark.sources.files import tail_activity, tail_lines, tail_table
from tidemark.streaming import once, records, writers


def line(i, kind, stamp):
    return json.dumps({
        "id": str(i), "type": kind, "actor": {"id": i, "login": f"u{i}"}, "repo": {"id": 1, "name": "o/r", "url": "https://x"},
        "payload": {"action": "x"}, "created_at": stamp, "org": {"id": 3},
    })


def drop(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def log(spark, folder):
    lines = tail_lines(spark, str(folder), maxFilesPerTrigger="1")
    return records.flatten_records(records.parse_records(lines))


def run(stream, base, **options):
    writers.write_batches(stream, str(base / "out"), str(base / "check"), **options).awaitTermination()
    schema = options["each"](stream).schema if "each" in options else stream.schema
    return writers.read_batches(stream.sparkSession, str(base / "out"), schema)


def test_parse_and_flatten(spark, tmp_path):
    drop(tmp_path / "in", "a", line(1, "PushEvent", "2024-01-01T05:30:00Z"), "broken")
    out = run(log(spark, tmp_path / "in"), tmp_path).drop(writers.BATCH)
    assert out.columns == ["id", "type", "actor_id", "actor_login", "repo_id", "repo_name", "repo_url", "ts"]
    rows = {r["id"]: tuple(r) for r in out.collect()}
    assert rows["1"] == ("1", "PushEvent", 1, "u1", 1, "o/r", "https://x", datetime(2024, 1, 1, 5, 30))
    assert rows[None] == (None,) * 8


def test_sub_objects_left_as_text(spark):
    df = spark.createDataFrame([(bytearray(line(1, "PushEvent", "x"), "utf8"),)], "value binary")
    data = records.parse_records(df).first()["data"]
    assert json.loads(data["payload"]) == {"action": "x"} and json.loads(data["org"]) == {"id": 3}


def test_late_row_of_a_closed_window_is_dropped(spark, tmp_path):
    folder = tmp_path / "in"
    drop(folder, "1", line(1, "PushEvent", "2024-01-01T05:30:00Z"), line(2, "PushEvent", "2024-01-01T05:40:00Z"))
    drop(folder, "2", line(3, "PushEvent", "2024-01-01T08:30:00Z"))
    run(records.window_counts(log(spark, folder)), tmp_path)
    drop(folder, "3", line(4, "PushEvent", "2024-01-01T05:50:00Z"), line(5, "PushEvent", "2024-01-01T10:00:00Z"))
    out = run(records.window_counts(log(spark, folder)), tmp_path).drop(writers.BATCH)
    assert sorted(tuple(r) for r in out.collect()) == [
        (datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 6), "PushEvent", 2),
        (datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 9), "PushEvent", 1),
    ]


def test_running_totals_over_batches_and_a_restart(spark, tmp_path):
    folder = tmp_path / "in"
    drop(folder, "1", line(1, "PushEvent", "2024-01-01T05:30:00Z"))
    drop(folder, "2", line(2, "PushEvent", "2024-01-01T05:30:00Z"), line(3, "WatchEvent", "2024-01-01T05:30:00Z"))
    run(records.type_counts(log(spark, folder)), tmp_path, mode="update")
    drop(folder, "3", line(4, "PushEvent", "2024-01-01T05:30:00Z"))
    batches = run(records.type_counts(log(spark, folder)), tmp_path, mode="update")
    assert batches.select(writers.BATCH).distinct().count() == 3
    totals = writers.newest_per_key(batches, "type", "events")
    assert sorted(tuple(r) for r in totals.collect()) == [("PushEvent", 3), ("WatchEvent", 1)]


def test_counts_of_each_batch(spark, tmp_path):
    folder = tmp_path / "in"
    for i in range(3):
        drop(folder, str(i), line(i, "PushEvent", "2024-01-01T05:30:00Z"))
    batches = run(log(spark, folder), tmp_path, each=records.type_counts)
    assert [tuple(r) for r in batches.orderBy(writers.BATCH).collect()] == [("PushEvent", 1, b) for b in range(3)]


def test_replayed_batch_replaces_itself(spark, tmp_path):
    folder = tmp_path / "in"
    drop(folder, "1", line(1, "PushEvent", "2024-01-01T05:30:00Z"))
    run(log(spark, folder), tmp_path, each=records.type_counts)
    out = writers.write_batches(log(spark, folder), str(tmp_path / "out"), str(tmp_path / "fresh"), each=records.type_counts)
    out.awaitTermination()
    rows = writers.read_batches(spark, str(tmp_path / "out"), records.type_counts(log(spark, folder)).schema)
    assert rows.agg(F.sum("events")).first()[0] == 1


def test_word_count_keeps_the_last_complete_table(spark, tmp_path):
    folder = tmp_path / "in"
    drop(folder, "1", "a b a")
    drop(folder, "2", "b c")
    counted = word_count(tail_lines(spark, str(folder), maxFilesPerTrigger="1"))
    out = writers.newest_batch(run(counted, tmp_path, mode="complete"))
    assert sorted(tuple(r) for r in out.collect()) == [("a", 2), ("b", 2), ("c", 1)]


def test_landing_takes_each_file_once(spark, tmp_path):
    folder, out, check = tmp_path / "in", str(tmp_path / "ods"), str(tmp_path / "check")
    drop(folder, "1.json", line(1, "PushEvent", "2024-01-01T05:30:00Z"))
    for extra in (None, "2.json", None):
        if extra:
            drop(folder, extra, line(2, "WatchEvent", "2024-01-01T06:30:00Z"))
        writers.land_files(tail_activity(spark, str(folder)), out, check).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == ["1", "2"]


def test_target_writer_stamps_each_batch(spark, tmp_path):
    folder = tmp_path / "in"
    drop(folder, "1", line(1, "PushEvent", "2024-01-01T05:30:00Z"))
    target = FileTarget(str(tmp_path / "counts"))
    query = writers.write_target(
        log(spark, folder), target, str(tmp_path / "check"), mode="append", each=records.type_counts, every="1 second"
    )
    query.processAllAvailable()
    query.stop()
    assert [(r["type"], r["events"]) for r in spark.read.parquet(target.path).collect()] == [("PushEvent", 1)]
    assert spark.read.parquet(target.path).columns == ["type", "events", "updated_at", "batch_id"]


def test_console_writer_runs_to_the_end(spark, tmp_path):
    drop(tmp_path / "in", "1", "a b")
    query = writers.write_console(word_count(tail_lines(spark, str(tmp_path / "in"))), str(tmp_path / "check"))
    query.awaitTermination()
    assert query.exception() is None


def test_many_batches_equal_one_batch(spark, tmp_path):
    """The events as six files in time order, one per batch: closed windows hold the batch counts."""
    folder = tmp_path / "events"
    folder.mkdir()
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").orderBy("ts").toPandas()
    size = -(-len(events) // 6)
    for part in range(6):
        path = folder / f"{part}.parquet"
        events.iloc[part * size:(part + 1) * size].to_parquet(path, coerce_timestamps="us")
        os.utime(path, (1_700_000_000 + part, 1_700_000_000 + part))
    schema = spark.read.parquet("/root/testdata/sf0.001/events.parquet").schema
    stream = tail_table(spark, str(folder), schema, maxFilesPerTrigger="1").withColumnRenamed("event_type", "type")
    out = run(records.window_counts(stream), tmp_path)
    assert out.select(writers.BATCH).distinct().count() > 3

    whole = spark.createDataFrame(events).select(F.date_trunc("hour", "ts").alias("hour"), F.col("event_type").alias("type"))
    limit = events["ts"].max() - pd.Timedelta(minutes=1)
    expected = {
        (r["hour"], r["type"]): r["n"]
        for r in whole.groupBy("hour", "type").agg(F.count("*").alias("n")).collect()
        if r["hour"] + timedelta(hours=1) <= limit
    }
    assert {(r["window_start"], r["type"]): r["events"] for r in out.collect()} == expected


def test_shared_folder_is_the_same_on_any_master(spark):
    class Session:
        conf = {"spark.sql.warehouse.dir": "hdfs:///w/"}

    assert shared_dir(Session()) == "hdfs:///w/_shared"
    Session.conf = {"spark.checkpoint.dir": "hdfs:///x/", "spark.sql.warehouse.dir": "hdfs:///w"}
    assert new_run_dir(Session(), "a").startswith("hdfs:///x/tidemark/a-")


def test_batches_are_folded_into_snapshots(spark, tmp_path):
    out, schema = str(tmp_path / "out"), T._parse_datatype_string("type string, events bigint")
    fold = writers.newest_rows("type")

    def batch(n):
        return spark.createDataFrame([("a", 10 * n), (f"b{n % 3}", n)], schema)

    def totals():
        return {r["type"]: r["events"] for r in writers.newest_per_key(writers.read_batches(spark, out, schema), "type", "events").collect()}

    for n in range(30):
        batch(n).write.parquet(f"{out}/batch_id={n}")
        if n % 5 == 4:
            before = totals()
            writers.compact(spark, out, schema, fold)
            assert totals() == before
    assert totals() == {"a": 290, "b0": 27, "b1": 28, "b2": 29}
    read = writers.read_batches(spark, out, schema).inputFiles()
    assert all("/_snapshots/upto=29/" in f for f in read)
    assert len(writers._numbered(spark, out, "batch_id")) <= 10 and len(writers._snapshots(spark, out)) == 2


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    drop(tmp_path / "in", "a", *[line(i, "PushEvent", "2024-01-01T05:30:00Z") for i in range(3)])
    drop(tmp_path / "in", "b", line(7, "WatchEvent", "2024-01-01T05:30:00Z"))
    options = {"mode": "update", "fold": writers.newest_rows("type"), "fold_after": 1}
    counts = records.type_counts(log(spark, tmp_path / "in"))
    first = writers.newest_per_key(run(counts, tmp_path, **options), "type", "events").collect()
    # The checkpoint is lost: the same batches come again, with the same numbers.
    writers.write_batches(counts, str(tmp_path / "out"), str(tmp_path / "other"), **options).awaitTermination()
    again = writers.newest_per_key(writers.read_batches(spark, str(tmp_path / "out"), counts.schema), "type", "events").collect()
    assert sorted(first) == sorted(again) == [("PushEvent", 3), ("WatchEvent", 1)]


def test_sums_are_folded(spark):
    rows = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("b", 5, 1)], "type string, events bigint, batch_id bigint")
    assert sorted(tuple(r) for r in writers.summed_rows("type", "events")(rows).collect()) == [("a", 3, 1), ("b", 5, 1)]


def test_every_event_is_appended_once(spark, tmp_path):
    """Copies within a batch, across batches, across restarts, within the lateness and long after it."""
    folder, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    at = lambda hour: f"2024-01-01T{hour:02d}:30:00Z"

    def round_():
        once.append_once(lambda: log(spark, folder), out, check, lateness="1 hour")
        return sorted(r["id"] for r in once.read_once(spark, out, log(spark, folder).schema).collect())

    drop(folder, "1", line(1, "PushEvent", at(5)), line(1, "PushEvent", at(5)), line(2, "PushEvent", at(5)))
    drop(folder, "2", line(2, "PushEvent", at(5)), line(3, "PushEvent", at(12)), "broken")
    assert round_() == ["1", "2", "3"] == round_()
    drop(folder, "3", line(1, "PushEvent", at(5)), line(4, "PushEvent", at(4)), line(3, "PushEvent", at(12)), line(6, "PushEvent", "no time"))
    assert round_() == ["1", "2", "3", "4", "6"]
    drop(folder, "4", line(4, "PushEvent", at(4)), line(5, "PushEvent", at(20)), line(4, "PushEvent", at(4)), line(6, "PushEvent", "no time"))
    assert round_() == ["1", "2", "3", "4", "5", "6"]



def test_batches_of_the_once_query_are_read_by_several_tasks(spark, tmp_path, monkeypatch):
    """A batch has a file for each task that has rendered rows of it, and its span is found without a shuffle of its rows."""
    rows = spark.range(400).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id as int)) as ts", "id % 7 as user_id",
        "'view' as event_type", "1.0d as value", "'{\"k\": 1}' as props")
    rows.repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(live, "new_run_dir", lambda s, label: f"{tmp_path}/run")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 27))
    try:
        got = live.stream_dedupe(spark, str(tmp_path))
        assert sorted(r["id"] for r in got.select("id").collect()) == list(range(400))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len([f for f, _ in folders.tree(spark, f"{tmp_path}/run/in") if f.endswith(".parquet")]) > 5
