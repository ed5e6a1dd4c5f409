"""The recurring jobs end to end: land, split, sync, analyse; each round twice."""

import gzip
import json
import re
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import __main__ as command
from tidemark.bindings import views
from tidemark.operators.dedupe import new_events
from tidemark.plans import jobs
from tidemark.operators.ledger import archive_states
from tidemark.plans.jobs import (
    Warehouse, analyse, archive_log, catch_up, collect, follows, land, live, prepare, profiles, split, split_landed, sync_table,
    to_refresh, upsert_dimension, with_current_dimensions,
)
from tidemark.operators.events import recent
from tidemark.plans.results import JOBS, RESULTS
from tidemark.sinks.publish import CatalogTarget, FileTarget, publish, stored_rows
from tidemark.schemas import RAW_EVENT
from tidemark.session import shared_dir
from tidemark.sources import folders
from tidemark.sources.files import parse_lines, tail_lines


def event(i, kind, hour, **payload):
    return json.dumps({
        "id": str(i), "type": kind, "actor": {"id": i % 3, "login": f"u{i % 3}"}, "repo": {"id": i % 2, "name": f"o/r{i % 2}"},
        "payload": payload, "public": True, "created_at": f"2024-01-01T{hour:02d}:10:00Z",
    })


def issue(number):
    return {"id": 100 + number, "state": "open", "comments": 0, "number": number, "created_at": "2024-01-01T05:00:00Z", "closed_at": None}


def users(spark, day, *people):
    rows = [(i, f"u{i}", followers, datetime(2024, 1, day)) for i, followers in people]
    frame = spark.createDataFrame(rows, "id bigint, login string, followers int, updated_at timestamp_ntz")
    text = ("company", "location", "email", "bio", "blog", "hireable", "twitter_username")
    numbers = ("following", "public_repos", "public_gists")
    return frame.withColumns({c: F.lit("Here, There") for c in text} | {c: F.lit(1) for c in numbers})


def repos(spark, *ids):
    rows = [(i, f"r{i}", f"o/r{i}", "Go", datetime(2024, 1, 1)) for i in ids]
    return spark.createDataFrame(rows, "id bigint, name string, full_name string, language string, updated_at timestamp_ntz")


def test_rounds(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    house = Warehouse(spark, str(tmp_path / "house"))

    (landing / "5.json").write_text("\n".join(
        [event(i, "PushEvent", 5, push_id=i, size=1, distinct_size=1) for i in range(6)]
        + [event(10, "IssuesEvent", 5, action="opened", issue=issue(1))]
        + [event(0, "PushEvent", 5, push_id=0, size=1, distinct_size=1)]
    ))
    land(house, str(landing))
    split_landed(house, loaded_at=1.0)
    assert house.fact("pushTable").count() == 6
    assert house.table("issue").count() == 1

    land(house, str(landing))
    split_landed(house, loaded_at=2.0)
    assert house.fact("pushTable").count() == 6

    (landing / "6.json").write_text("\n".join(
        [event(i, "PushEvent", 6, push_id=i, size=1, distinct_size=1) for i in range(20, 23)]
        + [event(5, "PushEvent", 5, push_id=5, size=1, distinct_size=1)]
        + [event(10, "IssuesEvent", 5, action="opened", issue=issue(1)), event(11, "IssuesEvent", 6, action="opened", issue=issue(2))]
    ))
    land(house, str(landing))
    split_landed(house, loaded_at=3.0)
    split(house, house.table("ods"), "again", loaded_at=0.5)
    assert house.fact("pushTable").count() == 9
    assert sorted(r["id"] for r in house.table("issue").collect()) == [101, 102]

    for load, source in (("a", users(spark, 1, (0, 5), (1, 6), (2, 7))), ("b", users(spark, 2, (1, 60))), ("c", users(spark, 2, (1, 60)))):
        sync_table(house, "users", source, load)
    sync_table(house, "repos", repos(spark, 0, 1), "a")
    assert house.table("users").count() == 4

    house.register_views()
    assert spark.sql("SELECT count(*) FROM pushTable WHERE time = '2024-01-01-06'").first()[0] == 3
    assert spark.table("issue").columns == ["id", "state_reason", "state", "comments", "number", "start_time", "end_time"]

    inputs = house.inputs()
    hourly = RESULTS["topActiveUser"](inputs)._jdf.queryExecution().executedPlan().toString()
    facts_scan = next(row for row in hourly.splitlines() if "/house/facts" in row)
    assert "event_date" in facts_scan and re.search(r"PartitionFilters: \[[^\]]*type#[^\]]*Subquery", facts_scan)
    assert "id#" not in re.sub("(actor|load)_id#", "", facts_scan)
    last = recent(house.table("facts"), 20, inputs.hour, inputs.date)
    assert sorted(r["id"] for r in last.collect()) == ["11", "20", "21", "22"]

    current = with_current_dimensions(inputs, JOBS)
    assert current.users.count() == 3 and current.repos.count() == 2
    assert with_current_dimensions(inputs, ["events"]) is inputs

    published = tmp_path / "published"
    for _ in range(2):
        analyse(house.inputs(), lambda name: [FileTarget(str(published / name))], datetime(2024, 2, 1))

    def rows(name, *columns):
        return spark.read.parquet(str(published / name)).select(*columns).collect()

    assert sorted(p.name for p in published.iterdir()) == sorted(n for names in JOBS.values() for n in names)
    assert [tuple(r) for r in rows("eventCount", "pushEventCount", "issuesEventCount", "created_at")] == [(3, 1, datetime(2024, 1, 1, 6))]
    assert [tuple(r) for r in rows("eventAllCount", "pushEventCount", "issuesEventCount")] == [(9, 2)]
    assert [tuple(r) for r in rows("usersCount", "usersCount")] == [(3,)]
    assert sorted(tuple(r) for r in rows("topActiveUser", "login", "followers", "activity_cnt")) == [("u0", 5, 1), ("u1", 60, 1), ("u2", 7, 1)]
    assert [tuple(r) for r in rows("topActiveRegion", "location", "activity_cnt")] == [("There", 3)]
    assert [tuple(r) for r in rows("topLanguage", "language", "activity_cnt")] == [("Go", 3)]
    assert spark.read.parquet(str(published / "eventCount")).count() == 1


def test_prepare_prunes_and_keeps_broken_lines(spark, tmp_path):
    archive = tmp_path / "archive"
    archive.mkdir()
    with gzip.open(archive / "2024-01-01-5.json.gz", "wt") as f:
        f.write('{"id":"1","actor":{"url":"https://x","id":3},"tags":[]}\nbroken\n')
    for _ in range(2):
        prepare(spark, str(archive), str(tmp_path / "landing"), partitions=2)
    lines = sorted(r["value"] for r in spark.read.text(str(tmp_path / "landing")).collect())
    assert lines == ["broken", '{"id":"1","actor":{"id":3}}']


def test_archives_of_one_name_and_corrected_ones_are_all_loaded(spark, tmp_path):
    house, landing = Warehouse(spark, str(tmp_path / "house")), str(tmp_path / "landing")

    def put(folder, hour, *ids):
        (tmp_path / "archive" / folder).mkdir(parents=True, exist_ok=True)
        with gzip.open(tmp_path / "archive" / folder / f"2024-01-01-{hour}.json.gz", "wt") as f:
            f.write("\n".join(event(i, "PushEvent", hour, push_id=i) for i in ids))

    def states():
        found = archive_states(archive_log(house)).collect()
        return sorted((r["path"].partition("archive/")[2], r["state"]) for r in found)

    put("x", 5, 1, 2)
    put("y", 5, 3)
    put("x", 6, 4)
    assert catch_up(house, str(tmp_path / "archive"), landing, 1, 1.0) == 1
    assert states() == [("x/2024-01-01-6.json.gz", "split")]
    assert catch_up(house, str(tmp_path / "archive"), landing, 5, 2.0) == 2
    assert house.fact("pushTable").count() == 4 and {s for _, s in states()} == {"split"} and len(states()) == 3
    put("x", 5, 1, 2, 7, 8, 9)
    assert catch_up(house, str(tmp_path / "archive"), landing, 5, 3.0) == 1
    assert catch_up(house, str(tmp_path / "archive"), landing, 5, 4.0) == 0
    assert house.fact("pushTable").count() == 7 and len(states()) == 4


def test_a_round_of_archives_is_taken_up_where_it_stopped(spark, tmp_path, monkeypatch):
    house, landing = Warehouse(spark, str(tmp_path / "house")), str(tmp_path / "landing")
    (tmp_path / "archive").mkdir()
    (tmp_path / "archive" / "2024-01-01-5.json").write_text(event(1, "PushEvent", 5, push_id=1))
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "split_landed", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            catch_up(house, str(tmp_path / "archive"), landing, 5, 1.0)
    assert [r["state"] for r in archive_states(archive_log(house)).collect()] == ["landed"]
    assert catch_up(house, str(tmp_path / "archive"), landing, 5, 2.0) == 0
    assert [r["state"] for r in archive_states(archive_log(house)).collect()] == ["split"]
    assert house.fact("pushTable").count() == 1


def test_collected_documents_over_two_rounds(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    docs = lambda *rows: spark.createDataFrame([(json.dumps(r),) for r in rows], "doc string")
    user = lambda i, day, n: {"id": i, "login": f"u{i}", "followers": n, "updated_at": f"2024-01-{day:02d}T00:00:00Z"}
    split_raw = raw_events(spark, *[event(i, "PushEvent", 5, push_id=i) for i in range(6)])
    split_raw.withColumn("broken", F.lit(None).cast("string")).withColumn("event_date", F.lit("2024-01-01").cast("date")).write.parquet(house.path("ods"))
    wanted = lambda: sorted((r["kind"], r["id"]) for r in to_refresh(house).collect())
    assert wanted() == [("repo", "0"), ("repo", "1"), ("user", "0"), ("user", "1"), ("user", "2")]

    collect(house, "users", docs(user(0, 1, 5), user(1, 1, 6), {"login": "nobody"}))
    collect(house, "repos", docs({"id": 1, "name": "r1", "updated_at": "2024-01-01T00:00:00Z", "topics": ["a", "b"]}))
    assert wanted() == [("repo", "0"), ("user", "2")]
    for _ in range(2):
        collect(house, "users", docs(user(1, 3, 9), user(2, 3, 1), user(0, 1, 7)))
    stored = {r["id"]: r["followers"] for r in profiles(house, "users").current().collect()}
    assert stored == {0: 5, 1: 9, 2: 1} and wanted() == [("repo", "0")]
    assert profiles(house, "repos").current().first()["topics"] == "'a','b'"

    page = {"id": 1, "followers": [{"id": 2}], "following": [{"id": 3}, {"id": 4}]}
    collect(house, "follows", docs(page, {"id": 9, "followers": []}))
    collect(house, "follows", docs(page, {"id": 2, "following": [{"id": 1}, {"id": 5}]}))
    assert sorted(tuple(r) for r in follows(house).current().collect()) == [(1, 3), (1, 4), (2, 1), (2, 5)]


def raw_events(spark, *lines):
    return parse_lines(spark.createDataFrame([(line,) for line in lines], "value string"))


def test_loads_are_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    house = Warehouse(spark, str(tmp_path / "house"))
    split(house, raw_events(spark, *[event(i, "PushEvent", 5, push_id=i) for i in range(4)]), "a", 1.0)

    def seen():
        counts = RESULTS["eventAllCount"](house.inputs_of_events()).first()
        return house.fact("pushTable").count(), house.table("issue").count(), house.table("timestable").count(), counts["pushEventCount"]

    assert seen() == (4, 0, 1, 4)
    second = raw_events(spark, event(3, "PushEvent", 5, push_id=3), event(9, "PushEvent", 6, push_id=9), event(10, "IssuesEvent", 6, action="opened", issue=issue(1)))
    for stop in ("timestable", "repo_counts"):
        with monkeypatch.context() as patch:
            write = jobs._write_load

            def stops(rows, house, table, *more, stop=stop):
                if table == stop:
                    raise RuntimeError("stopped")
                write(rows, house, table, *more)

            patch.setattr(jobs, "_write_load", stops)
            with pytest.raises(RuntimeError):
                split(house, second, "b", 2.0)
        assert seen() == (4, 0, 1, 4) and house.loads() == ["a"]
    for _ in range(2):
        split(house, second, "b", 2.0)
        assert seen() == (5, 1, 2, 5) and house.loads() == ["a", "b"]
    assert house.hour().first()["created_at"] == datetime(2024, 1, 1, 6)


def test_counts_over_all_history_read_no_event(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    for load, hours in (("a", (5, 6)), ("b", (6, 7)), ("a", (5, 6)), ("c", (9,))):
        split(house, raw_events(spark, *[event(100 * h + i, "PushEvent" if i else "WatchEvent", h, push_id=i) for h in hours for i in range(5)]), load, 1.0)
    inputs = house.inputs_of_events()
    for name in ("eventAllCount", "eventCount", "eventAllRatio", "eventTrend", "userEvents", "repoEvents"):
        found = RESULTS[name](inputs)
        plain = RESULTS[name](replace(inputs, hours=None, actors=None, repo_events=None))
        assert found.columns == plain.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect())), name
        files = "\n".join(found.inputFiles())
        assert "/facts/" not in files and "_counts/" in files
    assert RESULTS["eventAllCount"](inputs).first()["pushEventCount"] == 16


def test_a_load_reads_the_loads_of_its_hours_only(spark, tmp_path, monkeypatch):
    house = Warehouse(spark, str(tmp_path / "house"))
    for load, hour in (("a", 5), ("b", 6), ("c", 7)):
        split(house, raw_events(spark, *[event(100 * hour + i, "PushEvent", hour, push_id=i) for i in range(3)]), load, 1.0)
    read = []
    monkeypatch.setattr(jobs, "new_events", lambda rows, stored, *key: read.append(stored.inputFiles()) or new_events(rows, stored, *key))
    split(house, raw_events(spark, event(800, "PushEvent", 8, push_id=1)), "d", 1.0)
    assert read == [[], []]
    split(house, raw_events(spark, event(600, "PushEvent", 6, push_id=1), event(603, "PushEvent", 6, push_id=1)), "e", 1.0)
    assert read[2] and all("load_id=b" in f for f in read[2])
    assert house.fact("pushTable").count() == 11


def test_nothing_staged_is_left(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    scratch = f"{shared_dir(spark)}/tidemark"
    before = {p for p, _, _ in folders.entries(spark, scratch)}
    split(house, raw_events(spark, event(1, "PushEvent", 5, push_id=1)), "a", 1.0)
    sync_table(house, "users", users(spark, 1, (0, 5), (1, 6)), "a")
    sync_table(house, "repos", repos(spark, 0, 1), "a")
    inputs = replace(house.inputs(), users=house.table("users"), user_order=("updated_at", "load_id"))
    targets = lambda name: [FileTarget(str(tmp_path / kind / name)) for kind in ("x", "y")]
    analyse(inputs, targets, datetime(2024, 2, 1), ["users", "user_activity"])
    assert {p for p, _, _ in folders.entries(spark, scratch)} == before


def test_lines_that_are_no_events_are_rejected(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    nameless = event(1, "PushEvent", 5, push_id=1).replace('"id": "1", "type"', '"type"')
    (landing / "5.json").write_text("\n".join([event(0, "PushEvent", 5, push_id=0), "{cut", nameless, nameless]))
    house = Warehouse(spark, str(tmp_path / "house"))
    for _ in range(2):
        land(house, str(landing))
        split_landed(house, loaded_at=1.0)
    rejects = spark.read.parquet(house.path("rejects")).collect()
    assert house.fact("pushTable").count() == 1 and len(rejects) == 3
    assert {r["value"] for r in rejects if r["reason"] == "broken"} == {"{cut"}
    assert all("push_id" in r["value"] for r in rejects if r["reason"] == "no id")


def test_repeated_load_keeps_its_rows(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    loads = [("a", users(spark, 1, (0, 5), (1, 6))), ("a", users(spark, 1, (0, 5), (1, 6))), ("b", users(spark, 1, (0, 5), (1, 6), (2, 7)))]
    for load, source in [*loads, loads[0], ("c", users(spark, 2, (1, 60)))]:
        sync_table(house, "users", source, load)
    rows = [(r["load_id"], r["id"], r["followers"]) for r in house.table("users").collect()]
    assert sorted(rows) == [("a", 0, 5), ("a", 1, 6), ("b", 2, 7), ("c", 1, 60)]


def test_publishing_again_after_a_stop_between_two_targets(spark, tmp_path):
    first, table = FileTarget(str(tmp_path / "files")), CatalogTarget("published_twice")

    class Stops:
        def write(self, df, as_of):
            raise RuntimeError("stopped")

    frame = spark.range(3)
    with pytest.raises(RuntimeError):
        publish(frame, [first, table, Stops()], as_of=datetime(2024, 2, 1))
    publish(frame, [first, table], as_of=datetime(2024, 2, 1))
    assert spark.read.parquet(first.path).count() == 3 and stored_rows(spark, table) == 3
    publish(frame, [first, table], as_of=datetime(2024, 2, 2))
    assert spark.read.parquet(first.path).count() == 6 and stored_rows(spark, table) == 6


def test_a_new_session_publishes_onto_what_an_earlier_one_wrote(spark):
    target = CatalogTarget("results_of_two_sessions.hourly")
    publish(spark.range(3), [target], as_of=datetime(2024, 2, 1))
    spark.sql("DROP TABLE results_of_two_sessions.hourly")  # as if the catalog had been in memory: the folder stays
    for _ in range(2):
        publish(spark.range(4), [target], as_of=datetime(2024, 2, 2))
    assert stored_rows(spark, target) == 7
    plain = CatalogTarget("plain_of_two_sessions")
    plain.write(spark.range(2))
    plain.write(spark.range(2))
    assert stored_rows(spark, plain) == 4


def test_upsert_versions(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    schema = "id int, login string, followers int, updated_at timestamp_ntz, seq int"
    first = spark.createDataFrame([(1, "a", 1, datetime(2024, 1, 1), 1), (2, "b", 1, datetime(2024, 1, 5), 2)], schema)
    second = spark.createDataFrame([(1, "A", 9, datetime(2024, 1, 2), 1), (2, "B", 9, datetime(2024, 1, 4), 2)], schema)
    updates = ("followers", "updated_at")
    upsert_dimension(house, "current_users", first, updates, ["seq"])
    for _ in range(2):
        out = upsert_dimension(house, "current_users", second, updates, ["seq"])
    assert out.columns == ["id", "login", "followers", "updated_at"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", 9, datetime(2024, 1, 2)), (2, "b", 1, datetime(2024, 1, 5))]


def test_live_counts_each_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1").write_text(event(1, "PushEvent", 5) + "\n" + event(2, "PushEvent", 5) + "\n")
    target = FileTarget(str(tmp_path / "counts"))
    query = live(tail_lines(spark, str(folder)), target, str(tmp_path / "check"), every="1 second")
    query.processAllAvailable()
    query.stop()
    back = spark.read.parquet(target.path)
    assert back.columns == ["type", "count", "updated_at", "batch_id"]
    assert [(r["type"], r["count"]) for r in back.collect()] == [("PushEvent", 2)]


def test_command_line_rounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(command, "build_session", lambda app: spark)
    archive, landing, root = (str(tmp_path / n) for n in ("archive", "landing", "house"))
    (tmp_path / "archive").mkdir()
    (tmp_path / "archive" / "5.json").write_text("\n".join(event(i, "PushEvent", 5, push_id=i) for i in range(4)))
    command.main(["prepare", archive, landing])
    command.main(["land", root, landing])
    command.main(["split", root])
    house = Warehouse(spark, root)
    sync_table(house, "users", users(spark, 1, (0, 5)), "a")
    sync_table(house, "repos", repos(spark, 0, 1), "a")
    spark.sql("CREATE DATABASE IF NOT EXISTS results")
    for _ in range(2):
        command.main(["analyse", root, str(tmp_path / "out"), "--jobs", "events"])
    command.main(["analyse", root, "results", "--jobs", "dashboard", "--target", "catalog"])
    command.main(["refresh", root, str(tmp_path / "refresh")])
    assert {r["name"] for r in spark.read.json(str(tmp_path / "refresh")).collect()} == {"u0", "u1", "u2", "o/r0", "o/r1"}
    (tmp_path / "docs").write_text(json.dumps({"id": 1, "login": "u1", "updated_at": "2024-01-01T00:00:00Z"}))
    command.main(["collect", root, "users", str(tmp_path / "docs")])
    assert {r["login"] for r in profiles(house, "users").current().collect()} == {"u1"}
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "2024-01-01-8.json").write_text(event(50, "PushEvent", 8, push_id=50))
    command.main(["catch-up", root, str(tmp_path / "more"), landing, "-n", "3", "--partitions", "2"])
    command.main(["missing", root, str(tmp_path / "missing")])
    assert [r["hour"][11:13] for r in spark.read.json(str(tmp_path / "missing")).collect()] == ["07", "06"]
    assert spark.table("results.userEvents").agg(F.sum("activity_cnt")).first()[0] == 4
    assert spark.read.parquet(str(tmp_path / "out" / "eventCount")).first()["pushEventCount"] == 4


def test_time_of_a_record_is_parsed_once(spark):
    """Five columns have it; the dates of an issue are two more, each with one search for an offset."""
    plan = jobs._parsed(spark.createDataFrame([], RAW_EVENT))._jdf.queryExecution().analyzed().toString()
    assert plan.count("RLIKE") == 3


def test_rendered_rows_have_tasks_for_every_core(spark, monkeypatch):
    monkeypatch.setattr(views, "FIXTURE_PARTITIONS", 1)
    tasks = views.dealt(spark.range(1000)).rdd.getNumPartitions()
    assert tasks == 3 * spark.sparkContext.defaultParallelism
