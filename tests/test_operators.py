"""Operators on hand-made rows: edges, ties, missing values, empty inputs, skew."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedupe, dims, events, facts, hours, issues, ledger, profiles, rankings, text
from tidemark.plans.results import JOBS, RESULTS, Inputs

T0 = datetime(2024, 1, 1, 5, 30)
HOUR = datetime(2024, 1, 1, 5)


@pytest.fixture
def hour(spark):
    return spark.createDataFrame([(HOUR,)], "created_at timestamp_ntz")


def rows(df):
    return [tuple(r) for r in df.collect()]


ISSUE = "id bigint, state string, state_reason string, comments string, number bigint, start_time timestamp_ntz, end_time timestamp_ntz"


def issue_frame(spark, records):
    return spark.createDataFrame(records, ISSUE)


def test_histograms_of_no_rows_are_zero(spark, hour):
    empty = issue_frame(spark, [])
    for hist in (issues.issue_interval_hist, issues.issue_comments_hist, issues.issue_number_hist):
        row = hist(empty, hour).first().asDict()
        assert row.pop("created_at") == HOUR
        assert row.pop("issueMaxInterval", None) is None
        assert set(row.values()) == {0}
    assert rows(issues.issue_basic(empty, hour)) == [(0, 0, 0, 0, 0, HOUR)]


def test_interval_counts_closed_issues_only(spark, hour):
    day = lambda n: datetime(2024, 1, n)
    df = issue_frame(spark, [
        (1, "closed", None, "0", 1, day(1), day(2)),
        (2, "closed", None, "0", 1, day(1), day(4)),
        (3, "closed", None, "0", 1, day(9), day(4)),
        (4, "closed", None, "0", 1, day(1), None),
        (5, "open", None, "0", 1, day(1), day(2)),
    ])
    row = issues.issue_interval_hist(df, hour).first().asDict()
    assert (row["I1"], row["I7"], row["others"], row["issueMaxInterval"]) == (2, 1, 1, 3)


def test_dirty_comment_text_goes_to_others(spark, hour):
    df = issue_frame(spark, [(i, "open", None, c, 1, T0, None) for i, c in enumerate(["0", "7", "abc", None, "1000001"])])
    row = issues.issue_comments_hist(df, hour).first().asDict()
    assert (row["C0"], row["C10"], row["others"]) == (1, 1, 3)
    assert rows(issues.issue_comment_freq(df)) == [(None, 2), (0, 1), (7, 1), (1000001, 1)]


def test_other_reason_ignores_null_and_counts_reopened(spark, hour):
    df = issue_frame(spark, [
        (1, "closed", "completed", "0", 1, T0, None), (2, "closed", "not_planned", "0", 1, T0, None),
        (3, "open", "reopened", "0", 1, T0, None), (4, "open", None, "0", 1, T0, None),
    ])
    assert rows(issues.issue_basic(df, hour)) == [(2, 2, 1, 1, 2, HOUR)]
    assert sorted(rows(issues.issue_state_breakdown(df)), key=repr) == sorted([
        ("closed", None, 2, False), ("open", None, 2, False),
        ("closed", "completed", 1, True), ("closed", "not_planned", 1, True),
    ], key=repr)


def test_profile_ratios(spark, hour):
    names = [*profiles.TEXT_FIELDS, *profiles.NUMBER_FIELDS]
    ddl = ", ".join([f"{n} string" for n in profiles.TEXT_FIELDS] + [f"{n} bigint" for n in profiles.NUMBER_FIELDS])

    def user(email, followers, following):
        values = dict.fromkeys(names)
        values.update(email=email, followers=followers, following=following, public_repos=0, public_gists=1)
        return tuple(values[n] for n in names)

    users = spark.createDataFrame(
        [user("", 5, 0), user("null", 0, 0), user(None, 3, 2), user("x", None, 1)], ddl
    )
    row = profiles.profile_ratios(users, hour).first()
    assert (row["email_ratio"], row["followers_following_ratio"], row["followers_ratio"]) == (50.0, 25.0, 50.0)
    assert (row["public_repos_ratio"], row["public_gists_ratio"], row["bio_ratio"]) == (0.0, 100.0, 0.0)
    assert profiles.profile_ratios(users.limit(0), hour).first()["email_ratio"] is None


def test_top_users_breaks_ties_by_id_and_puts_null_last(spark):
    users = spark.createDataFrame([(3, "c", 5), (1, "a", 5), (2, "b", None), (4, "d", 9)], "id int, login string, followers int")
    assert rows(profiles.top_users(users, "followers", 3)) == [(4, "d", 9), (1, "a", 5), (3, "c", 5)]


EVENT = "id bigint, type string, actor_id bigint, repo_id bigint, ts timestamp_ntz"


def test_counts_in_hour_ignore_other_hours(spark):
    df = spark.createDataFrame([
        (1, "PushEvent", 1, 1, datetime(2024, 1, 1, 4, 59, 59)), (2, "PushEvent", 1, 1, HOUR),
        (3, "WatchEvent", 1, 1, datetime(2024, 1, 1, 5, 59, 59)), (4, "ForkEvent", 1, 1, T0),
    ], EVENT)
    latest = hours.latest_hour(df)
    row = events.event_count(df, latest).first()
    assert (row["pushEventCount"], row["watchEventCount"], row["createEventCount"], row["created_at"]) == (1, 1, 0, HOUR)
    ratio = events.event_ratio(events.event_count(df, latest)).first()
    assert (ratio["pushEventRatio"], ratio["watchEventRatio"], ratio["createEventRatio"]) == (50.0, 50.0, 0.0)
    none = events.event_ratio(events.event_all_count(df.where("type = 'ForkEvent'"), latest)).first()
    assert none["pushEventRatio"] is None


def test_latest_loaded_hour(spark):
    times = spark.createDataFrame(
        [(2.0, "2024-01-01-05", "2024-01-01"), (9.0, "2024-01-01-04", "2024-01-01")],
        "timestamp_d double, time_hour string, time_day string",
    )
    assert rows(hours.latest_loaded_hour(times)) == [(datetime(2024, 1, 1, 4),)]


def test_issue_json_with_missing_members(spark):
    raw = spark.createDataFrame(
        [("1", "IssuesEvent", {"issue": '{"id":7,"state":"open","closed_at":null,"created_at":"2024-01-01T05:30:00Z"}'},
          "2024-01-01T05:30:00Z"), ("2", "PushEvent", {}, None), ("3", "IssuesEvent", {"issue": "broken"}, None)],
        "id string, type string, payload map<string,string>, created_at string",
    )
    assert rows(facts.issue_dim(raw)) == [(7, None, "open", None, None, T0, None), (None,) * 7]


def test_split_takes_only_known_types_and_own_columns(spark):
    payload = {"action": "opened", "issue": '{"id":7}', "number": "12", "size": "x"}
    raw = spark.createDataFrame(
        [(str(i), t, {"id": "1"}, {"id": "2"}, payload, "2024-01-01T05:30:00Z")
         for i, t in enumerate(["IssuesEvent", "PullRequestEvent", "PushEvent", "ForkEvent"])],
        "id string, type string, actor map<string,string>, repo map<string,string>, payload map<string,string>, created_at string",
    )
    out = {r["type"]: r.asDict() for r in facts.split_facts(raw).collect()}
    assert set(out) == {"IssuesEvent", "PullRequestEvent", "PushEvent"}
    assert out["IssuesEvent"]["payload_issue_id"] == 7 and out["IssuesEvent"]["payload_number"] is None
    assert out["PullRequestEvent"]["payload_number"] == 12 and out["PullRequestEvent"]["payload_issue_id"] is None
    assert out["PushEvent"]["payload_size"] is None and out["PushEvent"]["time"] == "2024-01-01-05"
    assert facts.fact(facts.split_facts(raw), "pullTable").columns == [
        "id", "type", "actor_id", "repo_id", "payload_action", "payload_number", "time",
    ]


def test_snapshot_tie_goes_to_the_higher_sequence(spark):
    history = spark.createDataFrame([(1, "a", T0, 1), (1, "b", T0, 2), (2, "c", None, 1)], "id int, v string, updated_at timestamp_ntz, seq int")
    out = dims.latest_snapshot(history, ["updated_at", "seq"], keep=["v"])
    assert sorted(rows(out)) == [(1, "b"), (2, "c")]


def test_empty_increment_keeps_the_mark(spark):
    source = spark.createDataFrame([(1, T0)], "id int, updated_at timestamp_ntz")
    later = datetime(2025, 1, 1)
    assert rows(dims.next_mark(dims.changed_since(source, later), later)) == [(later, 0)]
    assert rows(dims.next_mark(dims.changed_since(source, HOUR), HOUR)) == [(T0, 1)]
    assert rows(dims.changed_since(source, T0)) == []


USER = "id int, login string, followers int, updated_at timestamp_ntz"


def upsert(spark, stored, incoming):
    out = dims.merge_newest(
        spark.createDataFrame(stored, USER), spark.createDataFrame(incoming, USER + ", seq int"),
        ["followers", "updated_at"], ["seq"],
    )
    return sorted(rows(out))


def at(day):
    return datetime(2024, 1, day)


def test_upsert_newest_wins(spark):
    stored = [(1, "a", 1, at(5)), (2, "b", 1, at(5)), (3, "c", 1, at(5)), (4, "d", 1, at(5))]
    incoming = [(1, "A", 9, at(4), 1), (2, "B", 9, at(5), 2), (3, "C", 9, at(6), 3), (5, "E", 9, at(1), 4)]
    assert upsert(spark, stored, incoming) == [
        (1, "a", 1, at(5)), (2, "b", 1, at(5)), (3, "c", 9, at(6)), (4, "d", 1, at(5)), (5, "E", 9, at(1)),
    ]


def test_upsert_of_repeated_keys_equals_one_by_one(spark):
    stored = [(1, "a", 0, at(5)), (3, "x", 0, None)]
    incoming = [
        (1, "p", 1, at(7), 1), (1, "q", 2, at(9), 2), (1, "r", 3, at(9), 3), (1, "s", 4, at(6), 4),
        (2, "n", 1, at(3), 5), (2, "m", 2, at(2), 6), (2, "o", 3, at(8), 7), (3, "y", 5, at(9), 8),
        (4, "u", 1, None, 9), (4, "v", 2, at(3), 10),
    ]
    table = {r[0]: list(r) for r in stored}
    for id_, login, followers, updated, _ in incoming:
        row = table.get(id_)
        if row is None:
            table[id_] = [id_, login, followers, updated]
        elif row[3] is not None and updated is not None and row[3] < updated:
            row[2], row[3] = followers, updated
    assert upsert(spark, stored, incoming) == sorted(tuple(r) for r in table.values())


def test_dedupe_and_repeatable_append(spark):
    schema = "id string, v int, event_date date"
    one, two = date(2024, 1, 1), date(2024, 1, 2)
    stored = spark.createDataFrame([("a", 1, one), ("n", 1, None)], schema)
    incoming = spark.createDataFrame([("a", 1, one), ("b", 2, two), ("b", 2, two), ("n", 1, None)], schema)
    assert rows(dedupe.new_events(incoming, stored)) == [("b", 2, two)]
    fresh = dedupe.new_events(incoming, stored)
    assert rows(dedupe.new_events(incoming, stored.unionAll(fresh))) == []


def test_follow_edges(spark):
    docs = spark.createDataFrame([
        ('{"id":1,"followers":[{"id":2},{"id":3}]}',), ('{"id":1,"following":[{"id":3}],"followers":[]}',),
        ('{"id":2,"following":[{"id":1}]}',), ('{"id":9}',),
    ], "doc string")
    edges = dims.follow_edges(docs)
    assert sorted(rows(edges)) == [(1, 3), (2, 1), (3, 1)]
    stored = spark.createDataFrame([(2, 1)], "follower_id bigint, following_id bigint")
    assert sorted(rows(dims.insert_new(edges, stored, ["follower_id", "following_id"]))) == [(1, 3), (3, 1)]


def test_refresh_candidates_and_bots(spark):
    raw = spark.createDataFrame([
        ({"id": "1", "login": "a"}, {"id": "5", "name": "o/r"}), ({"id": "1", "login": "a"}, {"id": "6", "name": "o/s[bot]"}),
        ({"id": "2", "login": "ci[bot]"}, {"id": "5", "name": "o/r"}), ({"id": "3"}, {"id": "5", "name": "o/r"}),
    ], "actor map<string,string>, repo map<string,string>")
    assert sorted(rows(dims.refresh_candidates(raw))) == [("repo", "5", "o/r"), ("user", "1", "a")]
    people = spark.createDataFrame([("dependabot[bot]",), ("bot",), (None,)], "login string")
    assert sorted(rows(dims.exclude_bots(people)), key=repr) == [("bot",), (None,)]


def test_user_document(spark):
    doc = '{"id":42,"login":"x","site_admin":false,"name":null,"public_repos":23,"updated_at":"2023-04-12T14:26:29Z"}'
    row = dims.flatten_users(spark.createDataFrame([(doc,)], "doc string")).first()
    assert len(row) == 20
    assert (row["id"], row["site_admin"], row["name"], row["public_repos"]) == (42, "false", None, 23)
    assert row["updated_at"] == datetime(2023, 4, 12, 14, 26, 29)


def test_repo_document_without_sub_objects(spark):
    docs = spark.createDataFrame([('{"id":1,"owner":{"id":7},"license":null,"topics":[]}',)], "doc string")
    row = dims.flatten_repos(docs).first()
    assert len(row) == 33
    assert (row["owner_id"], row["license"], row["organization_id"], row["topics"]) == (7, None, None, "''")


def test_missing_hours_newest_first(spark):
    span = spark.createDataFrame([(at(1), datetime(2024, 1, 1, 4))], "first_hour timestamp_ntz, last_hour timestamp_ntz")
    fetched = spark.createDataFrame([(datetime(2024, 1, 1, h),) for h in (1, 1, 3)], "hour timestamp_ntz")
    assert rows(ledger.missing_hours(span, fetched)) == [(datetime(2024, 1, 1, h),) for h in (4, 2, 0)]
    assert rows(ledger.missing_hours(span, fetched, 1)) == [(datetime(2024, 1, 1, 4),)]


def test_word_count_keeps_empty_words(spark):
    lines = spark.createDataFrame([("a  b a",), ("",), (None,)], "value string")
    assert dict(rows(text.word_count(lines))) == {"a": 2, "": 2, "b": 1}


def test_trend_change(spark):
    df = spark.createDataFrame(
        [(i, "PushEvent", 1, 1, datetime(2024, 1, 1, h, 5)) for i, h in enumerate([0, 1, 1, 3])], EVENT
    )
    assert sorted(rows(events.event_trend(df))) == [
        (datetime(2024, 1, 1, 0), "PushEvent", 1, None), (datetime(2024, 1, 1, 1), "PushEvent", 2, 1),
        (datetime(2024, 1, 1, 3), "PushEvent", 1, -1),
    ]


def test_recent(spark):
    df = spark.createDataFrame([(i, "PushEvent", i, 1, datetime(2024, 1, 1, 5, m)) for i, m in enumerate([0, 39, 40, 41, 59])], EVENT)
    assert sorted(r["actor_id"] for r in events.recent(df, 20).collect()) == [2, 3, 4]


def test_rankings(spark):
    pushes = [(i, "PushEvent", 1, 7, T0) for i in range(3)] * 2 + [(9, "PushEvent", 2, 7, T0), (10, "WatchEvent", 2, 7, T0), (11, "PushEvent", 3, 8, T0)]
    activity = spark.createDataFrame(pushes, EVENT)
    users = spark.createDataFrame([
        (1, "old", "None", "x, France", 1, 1, 1, at(1)), (1, "new", "None", "Paris, France ", 1, 1, 1, at(2)),
        (2, "b", "acme", "France", 1, 1, 0, at(1)), (3, "c", None, None, 1, 1, 2, at(1)), (4, "idle", "acme", "X", 1, 1, 2, at(1)),
    ], "id bigint, login string, company string, location string, followers int, following int, public_repos int, updated_at timestamp_ntz")
    counts = rankings.activity_per(activity, "actor_id")
    top = rankings.active_users(counts, users, ["updated_at"])
    assert [(r["login"], r["activity_cnt"]) for r in top.collect()] == [("new", 3), ("c", 1)]
    assert rows(rankings.active_users(counts, users, ["updated_at"], k=1).select("login")) == [("new",)]
    assert rows(rankings.active_regions(counts, users, ["updated_at"])) == [("France", 4)]
    assert rows(rankings.active_companies(counts, users, ["updated_at"])) == [("acme", 1)]
    repos = spark.createDataFrame([(7, "r", "o/r", "C", at(1)), (7, "r", "o/r", "Go", at(2)), (8, "s", "o/s", "None", at(1))],
                                  "id bigint, name string, full_name string, language string, updated_at timestamp_ntz")
    per_repo = rankings.activity_per(activity, "repo_id")
    assert [(r["repo_id"], r["language"], r["activity_cnt"]) for r in rankings.active_repos(per_repo, repos, ["updated_at"]).collect()] == [
        (7, "Go", 4), (8, "None", 1),
    ]
    assert rows(rankings.active_languages(per_repo, repos, ["updated_at"])) == [("Go", 4)]


def test_current_table_is_joined_without_a_snapshot(spark):
    counts = spark.createDataFrame([(1, 4), (2, 3)], "id bigint, activity_cnt bigint")
    current = spark.createDataFrame([(1, "acme"), (2, "None"), (3, "idle")], "id bigint, company string")
    ranked = rankings.active_companies(counts, current, None)
    assert rows(ranked) == [("acme", 4)]
    assert "max(struct" not in ranked._jdf.queryExecution().executedPlan().toString()


def test_unique_events_need_no_distinct(spark):
    activity = spark.createDataFrame([(i, "PushEvent", i % 3, 7, T0) for i in range(30)], EVENT)
    plain = rankings.activity_per(activity, "actor_id")
    lean = rankings.activity_per(activity, "actor_id", unique=True)
    assert sorted(rows(plain)) == sorted(rows(lean)) == [(0, 10), (1, 10), (2, 10)]


def test_one_key_with_most_of_the_rows(spark):
    """A hot user and a hot copied event give the same results as counting by hand."""
    base = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("id"), F.lit("PushEvent").alias("type"),
        F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id") % 50).alias("actor_id"), F.lit(1).cast("bigint").alias("repo_id"),
        F.lit(T0).cast("timestamp_ntz").alias("ts"),
    )
    pairs, ids = set(), set()
    for i in range(30_000):
        event = 0 if i % 3 == 0 else i
        pairs.add((event, 1 if i % 2 == 0 else i % 50))
        ids.add(event)
    per_actor = {}
    for _, actor in pairs:
        per_actor[actor] = per_actor.get(actor, 0) + 1
    assert dict(rows(rankings.activity_per(base, "actor_id"))) == per_actor
    assert dedupe.dedupe_events(base).count() == len(ids)


def test_every_published_table_belongs_to_one_job():
    listed = [name for names in JOBS.values() for name in names]
    assert sorted(listed) == sorted(RESULTS)


def test_published_tables_have_fixed_columns(spark, hour):
    """Column lists do not depend on the data, not even on there being any."""
    from tidemark.bindings import views as V

    sf = "/root/testdata/sf0.001"
    full = Inputs(
        activity=V.view(spark, sf, "activity"), issues=V.view(spark, sf, "issues"),
        users=V.view(spark, sf, "user_history").withColumns({c: F.lit("x") for c in ("email", "bio", "blog", "hireable", "twitter_username")})
        .withColumn("public_gists", F.lit(1)),
        repos=V.view(spark, sf, "repo_history"), hour=hour, user_order=V.USER_ORDER, repo_order=V.REPO_ORDER,
    )
    empty = Inputs(full.activity.limit(0), full.issues.limit(0), full.users.limit(0), full.repos.limit(0), hour, V.USER_ORDER, V.REPO_ORDER)
    for name, build in RESULTS.items():
        assert build(full).columns == build(empty).columns, name
        assert build(empty).count() in (0, 1), name
