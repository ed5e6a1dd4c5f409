"""Readers, writers and connector options."""

import gzip
from datetime import datetime

import pytest

from tidemark.sinks.publish import CatalogTarget, ConnectorTarget, FileTarget, publish, stored_rows
from tidemark.sources import connectors as C
from tidemark.sources.files import read_activity, read_text
from tidemark.sources.marks import EPOCH, read_mark, write_mark

LINE = (
    '{"id":"1","type":"PushEvent","actor":{"id":5,"login":"a"},"repo":{"id":7},'
    '"payload":{"push_id":9,"commits":[{"m":"x"}]},"public":true,"created_at":"2015-01-01T15:00:01Z"}'
)


def test_activity_from_plain_and_gzip_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(LINE + "\n" + "broken\n")
    with gzip.open(tmp_path / "b.json.gz", "wt") as f:
        f.write(LINE.replace('"1"', '"2"') + "\n")
    rows = {r["id"]: r for r in read_activity(spark, str(tmp_path)).collect()}
    assert set(rows) == {"1", "2", None}
    assert rows["1"]["actor"] == {"id": "5", "login": "a"}
    assert rows["2"]["payload"] == {"push_id": "9", "commits": '[{"m":"x"}]'}
    assert rows["1"]["public"] == "true"


def test_lines_are_dealt_only_when_asked(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}\n" * 50)
    plan = lambda **options: read_text(spark, str(tmp_path), **options)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan() and "RoundRobin" in plan(partitions=5)


def test_marks(spark, tmp_path):
    path = str(tmp_path / "marks")
    assert read_mark(spark, path, "users") == EPOCH
    for day in (3, 2):
        mark = spark.createDataFrame([(datetime(2024, 1, day),)], "mark timestamp_ntz")
        write_mark(mark, path, "users", f"load-{day}")
    assert read_mark(spark, path, "users") == datetime(2024, 1, 3)
    assert read_mark(spark, path, "repos") == EPOCH


def test_catalog_target_creates_then_appends_by_name(spark):
    target = CatalogTarget("published_by_name")
    assert stored_rows(spark, target) == 0
    publish(spark.createDataFrame([(1, "x")], "a int, b string"), [target])
    publish(spark.createDataFrame([("y", 2)], "b string, a int"), [target])
    assert stored_rows(spark, target) == 2
    assert sorted(tuple(r) for r in spark.table("published_by_name").select("a", "b").collect()) == [(1, "x"), (2, "y")]


def test_publish_computes_once_and_stamps_the_run(spark, tmp_path):
    counter = spark.sparkContext.accumulator(0)

    def touch(batches):
        for pdf in batches:
            counter.add(len(pdf))
            yield pdf

    df = spark.range(10).mapInPandas(touch, "id bigint")
    targets = [FileTarget(str(tmp_path / "p")), FileTarget(str(tmp_path / "j"), "json"), FileTarget(str(tmp_path / "o"), "orc")]
    publish(df, targets, as_of=datetime(2024, 2, 1))
    assert counter.value == 10
    for target in targets:
        back = spark.read.format(target.format).load(target.path)
        assert back.count() == 10 and "updated_at" in back.columns


def test_overwrite_keeps_only_the_current_state(spark, tmp_path):
    target = FileTarget(str(tmp_path / "t"), mode="overwrite")
    publish(spark.range(5), [target])
    publish(spark.range(3), [target])
    assert spark.read.parquet(target.path).count() == 3


def test_jdbc_options():
    table = C.JdbcTable("jdbc:mysql://db/x", "users", "u", "secret", partition=("id", 1, 1000, 8))
    assert "secret" not in repr(table)
    assert table.read_options() == {
        "url": "jdbc:mysql://db/x", "driver": "com.mysql.cj.jdbc.Driver", "user": "u", "password": "secret",
        "dbtable": "users", "fetchsize": "10000",
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "1000", "numPartitions": "8",
    }
    since = table.since_options(datetime(2024, 1, 2, 3, 4, 5))
    assert since["dbtable"] == "(SELECT * FROM users WHERE updated_at >= '2024-01-02 03:04:05.000000') AS changed"
    assert table.write_options()["dbtable"] == "users"


def test_kafka_and_mongo_options():
    topic = C.KafkaTopic("h:9092", "activity", max_offsets_per_trigger=100, min_partitions=16)
    assert topic.read_options() == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "activity", "startingOffsets": "latest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "100", "minPartitions": "16",
    }
    assert topic.write_options() == {"kafka.bootstrap.servers": "h:9092", "topic": "activity"}
    mongo = C.MongoCollection("mongodb://h", "results", "eventCount")
    assert mongo.read_options() == mongo.write_options() == {
        "connection.uri": "mongodb://h", "database": "results", "collection": "eventCount",
    }


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_connector_target_passes_its_options(mode):
    calls = []

    class Writer:
        def __getattr__(self, name):
            return lambda *a, **k: calls.append((name, a, k)) or self

    class Frame:
        write = Writer()

    ConnectorTarget(C.MongoCollection("mongodb://h", "d", "c"), mode).write(Frame())
    assert [c[0] for c in calls] == ["format", "mode", "options", "save"]
    assert calls[0][1] == ("mongodb",) and calls[1][1] == (mode,)
