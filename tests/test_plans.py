"""Physical plans: one scan, filters at the scan, no cross join, Python only where it must be."""

import re

import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
QUERIES = {**contract.batch.QUERIES, **contract.live.QUERIES}
WRITES = {
    "ods_json_files", "publish_fanout", "publish_repeated", "sync_repeated", "land_rejects", "upsert_buckets_touched", "event_all_count_incremental",
    "user_event_counts_incremental", "append_indexed",
} | {n for n in QUERIES if n.startswith(("stream_", "ingest_"))}


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert ("Python" in text or "Pandas" in text) == (name == "prune_json")


@pytest.mark.parametrize("name, table, scans", [
    ("event_all_count", "events", 1), ("issue_interval_hist", "orders", 1), ("issue_state_breakdown", "orders", 1),
    ("profile_ratios", "customer", 1), ("fact_split", "events", 1), ("refresh_candidates", "events", 1),
    ("follow_edges", "lineitem", 1),
])
def test_one_scan(spark, name, table, scans):
    text = plan(spark, name)
    hour = len(re.findall(r"ReadSchema: struct<ts:timestamp_ntz>", text)) if table == "events" else 0
    assert len(re.findall(rf"FileScan parquet .*/{table}\.parquet", text)) - hour == scans


@pytest.mark.parametrize("name, column", [
    ("event_count_latest_hour", "ts"), ("top_active_users", "ts"), ("user_event_counts_recent", "ts"),
    ("incremental_since_watermark", "o_orderdate"),
])
def test_time_filter_reaches_the_scan(spark, name, column):
    assert re.search(rf"PushedFilters: \[[^\]]*GreaterThan(OrEqual)?\({column},", plan(spark, name))


@pytest.mark.parametrize("name, columns", [
    ("event_trend_hourly", "ts:timestamp_ntz,event_type:string,value:double"),
    ("user_event_counts", "user_id:bigint"),
    ("word_count", "text:string"),
])
def test_only_needed_columns_are_read(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(spark, name)


@pytest.mark.parametrize("name", ["latest_snapshot_users", "dedupe_events", "upsert_users", "word_count", "repo_event_counts"])
def test_rows_are_reduced_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert re.search(r"Exchange hashpartitioning.*\n.*Aggregate", text) or "partial_" in text


def test_snapshots_reduce_the_history_of_counted_keys_only(spark):
    text = plan(spark, "top_active_users")
    # The plan reads upwards: the join with the counts lies below the reduction, and the counts are made once.
    assert text.index("max(struct(") < re.search("Join .*Inner", text).start()
    assert len(re.findall(r"functions=\[count\(1\)\]", text)) == 1


def test_plans_do_not_depend_on_the_number_of_splits(spark):
    def shape():
        return re.sub(r"#\d+L?|plan_id=\d+|\d+", "", plan(spark, "fact_split"))

    before = shape()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert shape() == before
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_whole_tables_are_not_broadcast_by_hint():
    import pathlib

    root = pathlib.Path(__file__).resolve().parents[1] / "tidemark"
    code = "\n".join(p.read_text() for p in root.rglob("*.py") if p.parent.name != "llm")
    assert "broadcast(" not in code and "crossJoin" not in code and ".collect()" not in code and "toPandas" not in code
