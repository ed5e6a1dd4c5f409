"""Batch queries over the provided tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.bindings import views as V
from tidemark.functions.json_text import payload_as_text, prune_json
from tidemark.functions.text import quoted_list
from tidemark.functions.time import day_key, floor_hour, hour_key, parse_utc
from tidemark.operators import dedupe, dims, events, facts, hours, issues, ledger, profiles, rankings, text
from tidemark.plans import jobs, ranks, results
from tidemark.schemas import LANDED_EVENT
from tidemark.session import new_run_dir, ship_package
from tidemark.sinks.buckets import BucketedTable
from tidemark.sinks.publish import FileTarget, publish
from tidemark.sources.files import parse_lines, read_activity

# Dates that divide the user and repository histories into stored and incoming
# parts; the parts overlap so that older, equal and newer versions all occur.
STORED_BEFORE = datetime(1998, 7, 1)
INCOMING_FROM = datetime(1998, 1, 1)


def _activity(s, d):
    return V.view(s, d, "activity")


def _hour(s, d):
    return hours.latest_hour(V.table(s, d, "events"))


def _lines(s, d):
    return V.activity_lines(V.view(s, d, "activity"))


def _ods(s, d):
    return V.ods_rows(V.view(s, d, "activity"))


def _facts(s, d):
    return facts.split_facts(_ods(s, d))


def _issues(s, d):
    return V.view(s, d, "issues")


def _users(s, d):
    return V.view(s, d, "users")


def _user_history(s, d):
    return V.view(s, d, "user_history")


def _repo_history(s, d):
    return V.view(s, d, "repo_history")


def _hour_activity(s, d):
    activity = _activity(s, d)
    return activity.where(hours.within_hour(_hour(s, d)))


def _user_activity(s, d):
    return rankings.activity_per(_hour_activity(s, d), "actor_id")


def _repo_activity(s, d):
    return rankings.activity_per(_hour_activity(s, d), "repo_id")


def _all_user_activity(s, d):
    return rankings.activity_per(_activity(s, d), "actor_id")


def ods_scan(s: SparkSession, d: str) -> DataFrame:
    return parse_lines(_lines(s, d)).select(
        "id", "type", F.col("actor")["login"].alias("actor_login"), F.col("repo")["name"].alias("repo_name"),
        F.col("payload")["action"].alias("action"), F.col("payload")["issue"].alias("issue"), "public", "created_at",
    )


def json_files(s: SparkSession, d: str) -> DataFrame:
    """Write the raw lines as gzip JSON files, read them back through the file reader."""
    path = new_run_dir(s, "json-files")
    _lines(s, d).write.option("compression", "gzip").text(path)
    raw = read_activity(s, path)
    return raw.groupBy("type").agg(F.count("*").alias("events"), F.count_distinct("id").alias("ids"))


def hour_keys(s: SparkSession, d: str) -> DataFrame:
    raw = _ods(s, d).select("id", parse_utc(F.col("created_at")).alias("ts"))
    return raw.select("id", hour_key(F.col("ts")).alias("time_hour"), day_key(F.col("ts")).alias("time_day"))


def time_dim(s: SparkSession, d: str) -> DataFrame:
    return facts.time_dim(_ods(s, d), 1700000000.5)


def fact_split(s: SparkSession, d: str) -> DataFrame:
    return _facts(s, d)


def _fact_query(name: str):
    return lambda s, d: facts.fact(_facts(s, d), name)


def issue_dim(s: SparkSession, d: str) -> DataFrame:
    return facts.issue_dim(V.issue_rows(_issues(s, d)))


def dedupe_events(s: SparkSession, d: str) -> DataFrame:
    activity = _activity(s, d)
    return dedupe.dedupe_events(activity.unionAll(activity))


def distinct_activity(s: SparkSession, d: str) -> DataFrame:
    activity = _activity(s, d)
    return dedupe.distinct_activity(activity.unionAll(activity))


def append_new_events(s: SparkSession, d: str) -> DataFrame:
    """Events of the second half-month loaded onto a store that already has the first 20 days."""
    dated = _activity(s, d).withColumn("event_date", F.to_date("ts"))
    stored = dated.where(F.col("event_date") < F.lit("2024-01-21").cast("date"))
    incoming = dated.where(F.col("event_date") >= F.lit("2024-01-15").cast("date"))
    return dedupe.new_events(incoming.unionAll(incoming), stored)


def event_all_ratio(s: SparkSession, d: str) -> DataFrame:
    return events.event_ratio(events.event_all_count(_activity(s, d), _hour(s, d)))


def event_ratio_latest_hour(s: SparkSession, d: str) -> DataFrame:
    return events.event_ratio(events.event_count(_activity(s, d), _hour(s, d)))


def dim_counts(s: SparkSession, d: str) -> DataFrame:
    repos = events.dim_count(_repo_history(s, d), "reposCount")
    return events.dim_count(_user_history(s, d), "usersCount").withColumn("reposCount", repos.scalar())


def top_active_users(s: SparkSession, d: str) -> DataFrame:
    hour = _hour(s, d)
    counts = rankings.activity_per(_activity(s, d).where(hours.within_hour(hour)), "actor_id")
    return hours.stamp_hour(rankings.active_users(counts, _user_history(s, d), V.USER_ORDER), hour)


def top_active_repos(s: SparkSession, d: str) -> DataFrame:
    ranked = rankings.active_repos(_repo_activity(s, d), _repo_history(s, d), V.REPO_ORDER)
    return hours.stamp_hour(ranked, _hour(s, d))


def top_languages(s: SparkSession, d: str) -> DataFrame:
    ranked = rankings.active_languages(_repo_activity(s, d), _repo_history(s, d), V.REPO_ORDER)
    return hours.stamp_hour(ranked, _hour(s, d))


def incremental(s: SparkSession, d: str) -> DataFrame:
    return dims.changed_since(_user_history(s, d), INCOMING_FROM)


def advance_watermark(s: SparkSession, d: str) -> DataFrame:
    return dims.next_mark(incremental(s, d), INCOMING_FROM)


def _before(df: DataFrame) -> DataFrame:
    return df.where(F.col("updated_at") < F.lit(STORED_BEFORE).cast("timestamp_ntz"))


def _from(df: DataFrame) -> DataFrame:
    return df.where(F.col("updated_at") >= F.lit(INCOMING_FROM).cast("timestamp_ntz"))


def upsert_users(s: SparkSession, d: str) -> DataFrame:
    history = _user_history(s, d)
    stored = dims.latest_snapshot(_before(history), V.USER_ORDER).drop("seq")
    return dims.merge_newest(stored, _from(history), dims.USER_UPDATES, ["seq"])


def upsert_repos(s: SparkSession, d: str) -> DataFrame:
    history = _repo_history(s, d)
    stored = dims.latest_snapshot(_before(history), V.REPO_ORDER).drop("order_seq", "line_seq", "supp_seq")
    arrival = ["order_seq", "line_seq", "supp_seq", "size", "stargazers_count", "updated_at"]
    return dims.merge_newest(stored, _from(history), dims.REPO_UPDATES, arrival)


def upsert_buckets_touched(s: SparkSession, d: str) -> DataFrame:
    """The same upsert in a table of buckets: stored records, newer ones, and the stored ones again, which change nothing."""
    history = _user_history(s, d)
    table = BucketedTable(s, new_run_dir(s, "upsert-buckets"), history.drop("seq").schema, buckets=16)
    table.replace(_before(history), V.USER_ORDER)
    for incoming in (_from(history), _before(history)):
        table.upsert(incoming, dims.USER_UPDATES, ["seq"])
    return table.current()


def _loaded(s, d) -> jobs.Warehouse:
    """Activity in three overlapping loads, one of them repeated after a later one."""
    house = jobs.Warehouse(s, new_run_dir(s, "loads"))
    dated = _activity(s, d).withColumn("day", F.dayofmonth("ts"))
    for load, first, last in (("a", 1, 11), ("b", 9, 20), ("a", 1, 11), ("c", 18, 31)):
        jobs.split(house, V.ods_rows(dated.where(F.col("day").between(first, last)).drop("day")), load, 1700000000.5)
    return house


def _incremental_result(name: str):
    return lambda s, d: results.RESULTS[name](_loaded(s, d).inputs_of_events())


def append_indexed(s: SparkSession, d: str) -> DataFrame:
    """What the load of the last days has added to the loads before it, which share some of its days."""
    return _loaded(s, d).table("facts", ["c"]).select("id", "type", "actor_id", "repo_id", "ts", "event_date")


def rank_users_all_time(s: SparkSession, d: str) -> DataFrame:
    return ranks.rank_all(_all_user_activity(s, d), "activity_cnt", ["id"])


def _archives(s, d) -> tuple[DataFrame, DataFrame]:
    """Every hour of activity as an archive, and a log by which some are split, landed or prepared already."""
    hourly = _activity(s, d).groupBy(floor_hour(F.col("ts")).alias("hour")).agg(
        (F.count("*") * 100).alias("bytes"), *[F.count_if(F.col("type") == t).alias(t) for t in ("ReleaseEvent", "DeleteEvent", "IssuesEvent")])
    named = hourly.withColumn("path", F.concat(F.lit("archive/"), hour_key(F.col("hour")), F.lit(".json.gz")))
    steps = (("ReleaseEvent", "split"), ("DeleteEvent", "landed"), ("IssuesEvent", "prepared"))
    log = [ledger.entries(named.where(F.col(t) > 0), state) for t, state in steps]
    return named.select("path", "bytes", "hour"), log[0].unionAll(log[1]).unionAll(log[2])


def ledger_next(s: SparkSession, d: str) -> DataFrame:
    """The archives that are not split yet, and how far they have come."""
    return ledger.pending(*_archives(s, d))


def ledger_after_round(s: SparkSession, d: str) -> DataFrame:
    """The states of all archives after a round that took up what was missing and split what was landed."""
    available, log = _archives(s, d)
    prepared = ledger.entries(ledger.pending(available, log, "prepared"), "prepared")
    done = ledger.entries(ledger.archive_states(log).where("state = 'landed'"), "split")
    return ledger.archive_states(log.unionAll(prepared).unionAll(done))


def issue_basic_current(s: SparkSession, d: str) -> DataFrame:
    return issues.issue_basic(issues.current_issues(V.view(s, d, "issue_history")), _hour(s, d))


def issue_interval_current(s: SparkSession, d: str) -> DataFrame:
    return issues.issue_interval_hist(issues.current_issues(V.view(s, d, "issue_history")), _hour(s, d))


def topics_list(s: SparkSession, d: str) -> DataFrame:
    doc = F.from_json("doc", "id bigint, topics array<string>")
    docs = V.repo_docs(V.table(s, d, "part")).select(doc.alias("doc"))
    return docs.select("doc.id", quoted_list(F.col("doc.topics")).alias("topics"))


def _edges(s, d):
    return dims.follow_edges(V.follow_docs(V.table(s, d, "lineitem")))


def follow_edges_insert(s: SparkSession, d: str) -> DataFrame:
    lineitem = V.table(s, d, "lineitem").where(F.col("l_returnflag") == "R")
    stored = dims.follow_edges(V.follow_docs(lineitem))
    return dims.insert_new(_edges(s, d), stored, ["follower_id", "following_id"])


def missing_hours(s: SparkSession, d: str) -> DataFrame:
    activity = _activity(s, d)
    fetched = activity.where(F.col("type") == "ReleaseEvent").select(floor_hour(F.col("ts")).alias("hour"))
    return ledger.missing_hours(ledger.hour_span(V.table(s, d, "events")), fetched)


def pruned_pages(s: SparkSession, d: str) -> DataFrame:
    ship_package(s)
    return V.page_docs(V.table(s, d, "pages")).select("page_id", prune_json(F.col("doc")).alias("doc"))


def payload_text(s: SparkSession, d: str) -> DataFrame:
    lines = _lines(s, d).select(payload_as_text(F.col("value")).alias("value"))
    parsed = F.from_json("value", "id string, public boolean, actor struct<id:bigint>, payload string")
    inner = F.get_json_object("r.payload", "$.action")
    return lines.select(parsed.alias("r")).select(
        "r.id", "r.public", F.col("r.actor.id").alias("actor_id"), inner.alias("action")
    )


def publish_fanout(s: SparkSession, d: str) -> DataFrame:
    """One result published to a Parquet and a JSON folder, read back from both."""
    path = new_run_dir(s, "publish-fanout")
    trend = events.event_trend(_activity(s, d))
    targets = [FileTarget(f"{path}/parquet"), FileTarget(f"{path}/json", "json")]
    publish(trend, targets, as_of=datetime(2024, 2, 1))
    back = [
        s.read.schema("hour timestamp_ntz, type string, events bigint, change bigint").format(t.format).load(t.path)
        .drop("as_of").select("*", F.lit(t.format).alias("target"))
        for t in targets
    ]
    return back[0].unionByName(back[1])


def publish_repeated(s: SparkSession, d: str) -> DataFrame:
    """One result published twice for the same moment: the folder holds it once."""
    target = FileTarget(f"{new_run_dir(s, 'publish-repeated')}/trend")
    for _ in range(2):
        publish(events.event_trend(_activity(s, d)), [target], as_of=datetime(2024, 2, 1))
    return s.read.parquet(target.path).select("hour", "type", "events", "change")


def sync_repeated(s: SparkSession, d: str) -> DataFrame:
    """A dimension synced in two rounds, the first of them repeated after the second."""
    house = jobs.Warehouse(s, new_run_dir(s, "sync"))
    history = _user_history(s, d)
    for source, load in ((_before(history), "a"), (history, "b"), (_before(history), "a")):
        jobs.sync_table(house, "users", source, load)
    return s.read.schema(f"{_ddl(history)}, load_id string").parquet(house.path("users"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in df.schema)


def land_rejects(s: SparkSession, d: str) -> DataFrame:
    """Lines landed from files of which some are cut off and some have no id: every one is an event or a reject."""
    path = new_run_dir(s, "rejects")
    n = F.get_json_object("value", "$.id").cast("bigint")
    cut = F.when(n % 50 == 0, F.substring("value", 1, 30)).when(n % 50 == 1, F.regexp_replace("value", r'^\{"id":"\d+",', "{"))
    _lines(s, d).select(F.coalesce(cut, "value").alias("value")).write.text(f"{path}/landing")
    house = jobs.Warehouse(s, f"{path}/house")
    jobs.land(house, f"{path}/landing")
    landed = s.read.schema(LANDED_EVENT).parquet(house.path("ods"))
    kept = landed.where("id is not null").select(F.lit("event").alias("reason"))
    return kept.unionAll(dedupe.rejected(landed).select("reason")).groupBy("reason").agg(F.count("*").alias("lines"))


def _recent_activity(s, d):
    return rankings.activity_per(events.recent(_activity(s, d), 10), "actor_id")


QUERIES = {
    "ods_scan": ods_scan,
    "ods_json_files": json_files,
    "hour_key": hour_keys,
    "latest_hour": _hour,
    "time_dim": time_dim,
    "fact_split": fact_split,
    **{f"fact_{name}": _fact_query(name) for name in facts.FACT_SPECS},
    "issue_dim": issue_dim,
    "dedupe_events": dedupe_events,
    "distinct_activity": distinct_activity,
    "append_new_events": append_new_events,
    "event_all_count": lambda s, d: events.event_all_count(_activity(s, d), _hour(s, d)),
    "event_count_latest_hour": lambda s, d: events.event_count(_activity(s, d), _hour(s, d)),
    "event_all_ratio": event_all_ratio,
    "event_ratio_latest_hour": event_ratio_latest_hour,
    "event_trend_hourly": lambda s, d: events.event_trend(_activity(s, d)),
    "user_event_counts": lambda s, d: events.count_by(_activity(s, d), "actor_id"),
    "user_event_counts_recent": lambda s, d: events.count_by(events.recent(_activity(s, d)), "actor_id"),
    "repo_event_counts": lambda s, d: events.count_by(_activity(s, d), "repo_id"),
    "repo_event_counts_recent": lambda s, d: events.count_by(events.recent(_activity(s, d)), "repo_id"),
    "dim_counts": dim_counts,
    "issue_basic": lambda s, d: issues.issue_basic(_issues(s, d), _hour(s, d)),
    "issue_state_breakdown": lambda s, d: issues.issue_state_breakdown(_issues(s, d)),
    "issue_comment_freq": lambda s, d: issues.issue_comment_freq(_issues(s, d)),
    "issue_interval_hist": lambda s, d: issues.issue_interval_hist(_issues(s, d), _hour(s, d)),
    "issue_comments_hist": lambda s, d: issues.issue_comments_hist(_issues(s, d), _hour(s, d)),
    "issue_number_hist": lambda s, d: issues.issue_number_hist(_issues(s, d), _hour(s, d)),
    "profile_ratios": lambda s, d: profiles.profile_ratios(_users(s, d), _hour(s, d)),
    "top20_followers": lambda s, d: profiles.top_users(_users(s, d), "followers"),
    "top20_following": lambda s, d: profiles.top_users(_users(s, d), "following"),
    "top_active_users": top_active_users,
    "top_active_regions": lambda s, d: rankings.active_regions(_user_activity(s, d), _user_history(s, d), V.USER_ORDER),
    "top_active_companies": lambda s, d: rankings.active_companies(_user_activity(s, d), _user_history(s, d), V.USER_ORDER),
    "top_active_repos": top_active_repos,
    "top_languages": top_languages,
    "top_regions_all_time": lambda s, d: rankings.active_regions(_all_user_activity(s, d), _user_history(s, d), V.USER_ORDER),
    "top_companies_all_time": lambda s, d: rankings.active_companies(_all_user_activity(s, d), _user_history(s, d), V.USER_ORDER),
    "latest_snapshot_users": lambda s, d: dims.latest_snapshot(_user_history(s, d), V.USER_ORDER),
    "latest_snapshot_repos": lambda s, d: dims.latest_snapshot(_repo_history(s, d), V.REPO_ORDER),
    "incremental_since_watermark": incremental,
    "advance_watermark": advance_watermark,
    "upsert_users": upsert_users,
    "upsert_repos": upsert_repos,
    "flatten_users": lambda s, d: dims.flatten_users(V.user_docs(V.view(s, d, "users"))),
    "flatten_repos": lambda s, d: dims.flatten_repos(V.repo_docs(V.table(s, d, "part"))),
    "topics_list": topics_list,
    "upsert_buckets_touched": upsert_buckets_touched,
    "event_all_count_incremental": _incremental_result("eventAllCount"),
    "user_event_counts_incremental": _incremental_result("userEvents"),
    "append_indexed": append_indexed,
    "rank_users_all_time": rank_users_all_time,
    "ledger_next": ledger_next,
    "ledger_after_round": ledger_after_round,
    "issue_basic_current": issue_basic_current,
    "issue_interval_current": issue_interval_current,
    "follow_edges": _edges,
    "follow_edges_insert": follow_edges_insert,
    "exclude_bots": lambda s, d: dims.exclude_bots(_users(s, d)).select("id", "login"),
    "refresh_candidates": lambda s, d: dims.refresh_candidates(_ods(s, d)),
    "missing_hours": missing_hours,
    "word_count": lambda s, d: text.word_count(V.table(s, d, "conversations"), "text"),
    "prune_json": pruned_pages,
    "payload_as_text": payload_text,
    "publish_fanout": publish_fanout,
    "publish_repeated": publish_repeated,
    "sync_repeated": sync_repeated,
    "land_rejects": land_rejects,
    "top_regions_recent": lambda s, d: rankings.active_regions(_recent_activity(s, d), _user_history(s, d), V.USER_ORDER),
    "top_companies_recent": lambda s, d: rankings.active_companies(_recent_activity(s, d), _user_history(s, d), V.USER_ORDER),
}
