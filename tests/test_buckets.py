"""Bucketed current-state tables: what a round rewrites, what readers see, what a join shuffles."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import rankings
from tidemark.sinks.buckets import BucketedTable
from tidemark.sources import folders

USERS = "id bigint, login string, followers int, updated_at timestamp_ntz"


def people(spark, day, *rows):
    made = [(i, f"u{i}-{day}", f, datetime(2024, 1, day), n) for n, (i, f) in enumerate(rows)]
    return spark.createDataFrame(made, f"{USERS}, seq int")


@pytest.fixture
def table(spark, tmp_path):
    return BucketedTable(spark, str(tmp_path / "users"), T._parse_datatype_string(USERS), buckets=16)


def state(table):
    return {r["id"]: (r["login"], r["followers"], r["updated_at"].day) for r in table.current().collect()}


def lying(table):
    """Every data file with its size and time of change."""
    return {p: (n, t) for f, _, _ in folders.entries(table.spark, f"{table.root}/data") for p, n, t in folders.entries(table.spark, f) if p.endswith("parquet")}


def test_a_round_rewrites_the_touched_buckets_only(spark, table):
    updates = ("followers", "updated_at")
    assert table.current().count() == 0
    table.upsert(people(spark, 1, *[(i, 1) for i in range(200)]), updates, ["seq"])
    first, before = lying(table), table.files()
    touched = table.upsert(people(spark, 2, (3, 9), (500, 5)), updates, ["seq"])
    wanted = {r[0] for r in spark.createDataFrame([(3,), (500,)], "id bigint").select(table.bucket_of(F.col("id"))).collect()}
    assert set(touched) == wanted and len(wanted) <= 2
    now, after = lying(table), table.files()
    assert {p: s for p, s in first.items() if before[p][0] not in wanted} == {p: now[p] for p in first if before[p][0] not in wanted}
    assert {b for b, v in after.values() if v == 2} == wanted
    assert state(table)[3] == ("u3-1", 9, 2) and state(table)[500] == ("u500-2", 5, 2) and len(state(table)) == 201

    # An older version changes nothing, and a round without rows is no round.
    table.upsert(people(spark, 1, (3, 4)), updates, ["seq"])
    assert state(table)[3] == ("u3-1", 9, 2)
    assert table.upsert(people(spark, 3), updates, ["seq"]) == [] and table.pointer().version == 3


def test_old_versions_are_removed(spark, table):
    for day in range(1, 8):
        table.replace(people(spark, day, *[(i, day) for i in range(40)]), ["updated_at"])
    versions = {v for _, v in table._lying().values()}
    assert versions == {6, 7} and {v for _, v in table.files().values()} == {7}
    assert len(folders.entries(spark, f"{table.root}/pointer")) == 2
    assert all(v == (f"u{i}-7", 7, 7) for i, v in state(table).items())


def test_a_round_that_stopped_is_not_seen_and_can_be_run_again(spark, table, monkeypatch):
    table.replace(people(spark, 1, (1, 1), (2, 1)), ["updated_at"])
    with monkeypatch.context() as stop:
        stop.setattr(BucketedTable, "_point", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            table.replace(people(spark, 2, (1, 2), (3, 2)), ["updated_at"])
    assert state(table) == {1: ("u1-1", 1, 1), 2: ("u2-1", 1, 1)}
    table.replace(people(spark, 2, (1, 2)), ["updated_at"])
    assert state(table) == {1: ("u1-2", 2, 2), 2: ("u2-1", 1, 1)}


def test_a_reader_that_began_before_a_round_can_finish(spark, table):
    table.replace(people(spark, 1, (1, 1), (2, 1)), ["updated_at"])
    early = table.current()
    table.replace(people(spark, 2, (1, 2)), ["updated_at"])
    assert sorted(r["login"] for r in early.collect()) == ["u1-1", "u2-1"]


def test_another_session_finds_the_table(spark, table):
    table.replace(people(spark, 1, (1, 1)), ["updated_at"])
    spark.sql(f"DROP TABLE {table._name()}")  # as if the catalog had been in memory; the files stay
    again = BucketedTable(spark, table.root, table.schema, buckets=16)
    again.replace(people(spark, 2, (1, 2), (2, 2)), ["updated_at"])
    assert len(state(again)) == 2
    with pytest.raises(ValueError):
        BucketedTable(spark, table.root, table.schema, buckets=8).pointer()


def test_edges_are_added_once(spark, tmp_path):
    schema = T._parse_datatype_string("follower_id bigint, following_id bigint")
    edges = BucketedTable(spark, str(tmp_path / "edges"), schema, key="follower_id", buckets=8)
    rows = lambda *pairs: spark.createDataFrame(list(pairs), schema)
    edges.insert(rows((1, 2), (1, 2), (2, 3)), schema.names)
    first = lying(edges)
    edges.insert(rows((1, 2), (1, 3)), schema.names)
    assert sorted(tuple(r) for r in edges.current().collect()) == [(1, 2), (1, 3), (2, 3)]
    assert first.items() <= lying(edges).items()


def test_a_join_shuffles_only_the_other_side(spark, table):
    table.replace(people(spark, 1, *[(i, 1) for i in range(50)]), ["updated_at"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = spark.range(1000).select((F.col("id") % 50).alias("id")).groupBy("id").agg(F.count("*").alias("activity_cnt"))
        joined = counts.join(table.current(), "id")
        assert joined.count() == 50
        plan = joined._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        own = re.search(r"FileScan parquet \S+\[(id#\d+L)", final)[1]
        assert "Bucketed: true" in final and f"hashpartitioning({own}" not in final
        ranked = rankings.active_users(counts, table.current().withColumns({c: F.lit(1) for c in ("company", "location", "following", "public_repos")}), None)
        assert ranked.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
