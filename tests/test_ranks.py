"""Ranks by ranges and the states of archives."""

import random

import pytest

from tidemark.operators.ledger import archive_states, next_archives, pending
from tidemark.plans.ranks import rank_all


@pytest.mark.parametrize("values", [[], [5], [1] * 300, [None, 3, 3, None, 2], [random.Random(4).randrange(20) for _ in range(500)]])
def test_positions_and_shared_ranks(spark, values):
    rows = spark.createDataFrame(list(enumerate(values)), "id int, cnt int").repartition(3)
    found = sorted(rank_all(rows, "cnt", ["id"]).select("position", "rank", "id", "cnt").collect())
    order = sorted(enumerate(values), key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))
    cnts = [v for _, v in order]
    assert [tuple(r) for r in found] == [(n + 1, cnts.index(v) + 1, i, v) for n, (i, v) in enumerate(order)]


def test_no_task_sorts_everything(spark):
    plan = rank_all(spark.range(100).selectExpr("id", "id % 3 AS cnt"), "cnt", ["id"])._jdf.queryExecution().executedPlan().toString()
    # What meets in one task are the sizes of the ranges, a row each.
    lone = [below for below in plan.split("SinglePartition")[1:]]
    assert lone and all("Aggregate(keys=[_range" in below.replace("HashAggregate(key", "Aggregate(key").split("FileScan")[0] for below in lone)


def test_archive_states(spark):
    log = spark.createDataFrame([("x/5", 10, "prepared"), ("x/5", 10, "split"), ("x/5", 10, "landed"), ("y/5", 10, "landed")], "path string, bytes bigint, state string")
    assert sorted(tuple(r) for r in archive_states(log).collect()) == [("x/5", 10, "split"), ("y/5", 10, "landed")]
    available = spark.createDataFrame([("x/5", 10, 5), ("x/5", 11, 5), ("y/5", 10, 5), ("y/6", 1, 6)], "path string, bytes bigint, hour int")
    assert sorted((r["path"], r["bytes"], r["state"]) for r in pending(available, log).collect()) == [("x/5", 11, "missing"), ("y/5", 10, "landed"), ("y/6", 1, "missing")]
    assert [(r["path"], r["bytes"]) for r in next_archives(available, log, 2).collect()] == [("y/6", 1), ("x/5", 11)]
    assert next_archives(available.limit(0), log, 2).count() == 0
