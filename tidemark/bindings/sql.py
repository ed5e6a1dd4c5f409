"""Every batch and streaming query as plain SQL over the provided tables.

Used only to compare results; written against the tables, not the operators.
"""

from __future__ import annotations

from tidemark.bindings.batch import INCOMING_FROM, STORED_BEFORE
from tidemark.bindings.views import ctes
from tidemark.operators.dims import REPO_UPDATES, USER_UPDATES
from tidemark.operators.events import EVENT_COUNTS, EVENT_RATIOS
from tidemark.operators.facts import FACT_SPECS, PAYLOAD_COLUMNS

HOUR = "SELECT date_trunc('hour', max(ts)) AS created_at FROM events"
STAMP = "(SELECT created_at FROM hour) AS created_at"
IN_HOUR = "ts >= (SELECT created_at FROM hour)"

_A = ctes("activity")
_AH = ctes("activity", hour=HOUR)

_COUNTS = ", ".join(f"count(*) FILTER (WHERE type = '{t}') AS {n}" for n, t in EVENT_COUNTS.items())
_TOTAL = " + ".join(EVENT_RATIOS.values())
_RATIOS = ", ".join(
    f"round(CAST({c} AS DOUBLE) / nullif({_TOTAL}, 0) * 100.0, 2) AS {n}" for n, c in EVENT_RATIOS.items()
)


def _event_counts(where: str = "") -> str:
    return f"SELECT {_COUNTS}, {STAMP} FROM activity {where}"


def _event_ratios(where: str = "") -> str:
    counts = _event_counts(where)
    return ctes("activity", hour=HOUR, counts=counts) + f"SELECT {_RATIOS}, created_at FROM counts"


# Payload values the rendered records carry, by column; NULL for the other types.
_PAYLOAD = {
    "payload_ref": "CASE WHEN type IN ('CreateEvent', 'DeleteEvent') THEN concat('b', repo_id) END",
    "payload_ref_type": "CASE WHEN type IN ('CreateEvent', 'DeleteEvent') THEN 'branch' END",
    "payload_master_branch": "CASE WHEN type = 'CreateEvent' THEN 'main' END",
    "payload_description": "CASE WHEN type = 'CreateEvent' AND repo_id > 50 THEN concat('repo ', repo_id) END",
    "payload_pusher_type": "CASE WHEN type IN ('CreateEvent', 'DeleteEvent') THEN 'user' END",
    "payload_action": (
        "CASE type WHEN 'IssuesEvent' THEN 'opened' WHEN 'IssueCommentEvent' THEN 'created' "
        "WHEN 'PullRequestEvent' THEN 'closed' WHEN 'ReleaseEvent' THEN 'published' "
        "WHEN 'WatchEvent' THEN 'started' END"
    ),
    "payload_issue_id": "CASE WHEN type IN ('IssuesEvent', 'IssueCommentEvent') THEN id + 1000000 END",
    "payload_number": "CASE WHEN type = 'PullRequestEvent' THEN repo_id END",
    "payload_push_id": "CASE WHEN type = 'PushEvent' THEN id + 5000000 END",
    "payload_size": "CASE WHEN type = 'PushEvent' THEN repo_id END",
    "payload_distinct_size": "CASE WHEN type = 'PushEvent' THEN repo_id + 1 END",
    "payload_release_id": "CASE WHEN type = 'ReleaseEvent' THEN id + 7000000 END",
}
_ID = "CAST(id AS VARCHAR) AS id"
_TIME = "strftime(ts, '%Y-%m-%d-%H') AS time"


def _fact(table: str) -> str:
    spec = FACT_SPECS[table]
    payload = ", ".join(f"{_PAYLOAD[c]} AS {c}" for c in spec.payload)
    return _A + f"SELECT {_ID}, type, actor_id, repo_id, {payload}, {_TIME} FROM activity WHERE type = '{spec.event_type}'"


_FACT_SPLIT = _A + (
    f"SELECT {_ID}, type, actor_id, repo_id, "
    + ", ".join(f"{_PAYLOAD[c]} AS {c}" for c in PAYLOAD_COLUMNS)
    + f", {_TIME}, date_trunc('second', ts) AS ts, CAST(ts AS DATE) AS event_date FROM activity"
)

_INTERVALS = (1, 7, 30, 90, 180, 365, 730, 1095, 1460)
_LEVELS = (0, 10, 100, 1000, 10000, 100000, 1000000)


def _bands(value: str, prefix: str, edges: tuple[int, ...], exact_first: bool) -> str:
    """One filtered count per band, bounded on both sides, and the rest as ``others``."""
    columns, below = [], None
    for edge in edges:
        if exact_first and edge == 0:
            test = f"{value} = 0"
        else:
            test = f"{value} <= {edge}"
            if below is not None:
                test += f" AND {value} <> 0" if exact_first and below == 0 else f" AND {value} > {below}"
        columns.append(f"count(*) FILTER (WHERE {test}) AS {prefix}{edge}")
        below = edge
    columns.append(f"count(*) FILTER (WHERE {value} IS NULL OR {value} > {edges[-1]}) AS others")
    return ", ".join(columns)


_DAYS = "(CAST(end_time AS DATE) - CAST(start_time AS DATE))"
_INTERVAL_HIST = (
    f"SELECT {_bands(_DAYS, 'I', _INTERVALS, False)}, CAST(max({_DAYS}) AS INTEGER) AS \"issueMaxInterval\", {STAMP} "
    "FROM issues WHERE state = 'closed'"
)


def _newest(source: str, order: str, columns: str = "*", rank: str = "rn") -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {order}) AS {rank} "
        f"FROM {source}) q WHERE {rank} = 1"
    )


_USER_NEWEST = _newest("user_history", "updated_at DESC, seq DESC")
_REPO_DESC = (
    "updated_at DESC, order_seq DESC, line_seq DESC, supp_seq DESC, size DESC, stargazers_count DESC"
)
_REPO_NEWEST = _newest("repo_history", _REPO_DESC)


def _per(key: str, where: str = "") -> str:
    return (
        f"SELECT {key} AS id, count(DISTINCT id) AS activity_cnt FROM activity "
        f"WHERE type = 'PushEvent' {where} GROUP BY {key}"
    )


def _ranking(select: str, key: str, history: str, newest: str, hourly: bool, minutes: int = 0) -> str:
    where = f"AND {IN_HOUR}" if hourly else ""
    where += f" AND ts > (SELECT max(ts) FROM events) - INTERVAL {minutes} MINUTE" if minutes else ""
    return ctes("activity", history, hour=HOUR, cur=newest, cnt=_per(key, where)) + select


_REGION = "trim(CASE WHEN contains(location, ',') THEN string_split(location, ',')[-1] ELSE location END)"
_REGIONS = (
    f"SELECT {_REGION} AS location, CAST(sum(activity_cnt) AS BIGINT) AS activity_cnt "
    "FROM cnt JOIN cur USING (id) WHERE location <> 'None' GROUP BY 1"
)
_COMPANIES = (
    "SELECT company, CAST(sum(activity_cnt) AS BIGINT) AS activity_cnt "
    "FROM cnt JOIN cur USING (id) WHERE company <> 'None' GROUP BY 1"
)


def _upsert(history: str, key_columns: list[str], updates: tuple[str, ...], kept: list[str],
            newest_desc: str, arrival: str) -> str:
    stored = _newest(f"(SELECT * FROM {history} WHERE updated_at < TIMESTAMP '{STORED_BEFORE}')", newest_desc)
    incoming = f"(SELECT * FROM {history} WHERE updated_at >= TIMESTAMP '{INCOMING_FROM}')"
    first = _newest(incoming, arrival)
    newest = _newest(incoming, f"updated_at DESC, {arrival}")
    base = "CASE WHEN s.id IS NOT NULL THEN s.updated_at ELSE f.updated_at END"
    columns = [f"coalesce(s.{c}, f.{c}) AS {c}" for c in key_columns]
    columns += [f"CASE WHEN s.id IS NOT NULL THEN s.{c} ELSE f.{c} END AS {c}" for c in kept]
    columns += [
        f"CASE WHEN n.updated_at > {base} THEN n.{c} WHEN s.id IS NOT NULL THEN s.{c} ELSE f.{c} END AS {c}"
        for c in updates
    ]
    return ctes(history, s=stored, f=first, n=newest) + (
        f"SELECT {', '.join(columns)} FROM s FULL JOIN f ON s.id = f.id LEFT JOIN n ON n.id = f.id"
    )


_USER_KEPT = ["login", "company", "location"]
_REPO_KEPT = ["name", "full_name", "language"]

_DOC_DAY = "concat('2021-03-', lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0'), ' 10:00:29')"
_TOPICS = (
    "CASE WHEN p_size = 1 THEN '''''' WHEN p_size > 25 THEN "
    "concat('''', list_aggregate(list_transform(range(1, 21), lambda i: concat('t', i)), 'string_agg', ''','''), '''') END"
)
_STAMP_DOC = f"CAST({_DOC_DAY} AS TIMESTAMP)"

_EDGES = """
    SELECT l_partkey AS follower_id, l_suppkey AS following_id FROM lineitem WHERE l_returnflag <> 'N'
    UNION SELECT l_suppkey, l_orderkey FROM lineitem WHERE l_linestatus = 'O'
    UNION SELECT l_suppkey, l_partkey FROM lineitem WHERE l_linestatus = 'O'"""
_R_EDGES = """
    SELECT l_partkey AS follower_id, l_suppkey AS following_id FROM lineitem WHERE l_returnflag = 'R'
    UNION SELECT l_suppkey, l_orderkey FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag = 'R'
    UNION SELECT l_suppkey, l_partkey FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag = 'R'"""

_TREND = (
    "SELECT hour, type, events, events - lag(events) OVER (PARTITION BY type ORDER BY hour) AS change FROM "
    "(SELECT date_trunc('hour', ts) AS hour, type, count(*) AS events FROM activity GROUP BY 1, 2) h"
)

_IS_URL = "(contains(url, 'http://') OR contains(url, 'https://'))"
_IS_URL_HTML = "(contains(html, 'http://') OR contains(html, 'https://'))"
_PRUNED = f"""
    SELECT page_id, concat(
        '{{"id":', page_id,
        CASE WHEN {_IS_URL} THEN '' ELSE concat(',"link":', to_json(url)) END,
        CASE WHEN {_IS_URL_HTML} THEN '' ELSE concat(',"html":', to_json(html)) END,
        ',"size":', length(html),
        ',"links":[', to_json(url), ',"plain"]',
        ',"emptied":', CASE WHEN {_IS_URL} THEN '{{}}' ELSE concat('{{"href":', to_json(url), '}}') END,
        ',"meta":{{"inner":{{', CASE WHEN {_IS_URL} THEN '' ELSE concat('"self":', to_json(url), ',') END,
        '"n":', page_id, '}},"items":[{{', CASE WHEN {_IS_URL} THEN '' ELSE concat('"u":', to_json(url), ',') END,
        '"k":1}}]}}}}') AS doc
    FROM pages"""

_BOT_SUFFIX = "CASE WHEN actor_id % 10 = 0 THEN '[bot]' ELSE '' END"


def _count_by(key: str, recent: bool) -> str:
    where = "WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 20 MINUTE" if recent else ""
    return _A + f"SELECT {key}, count(*) AS activity_cnt FROM activity {where} GROUP BY {key}"


_ARCHIVES = ctes("activity", archive="""SELECT concat('archive/', strftime(date_trunc('hour', ts), '%Y-%m-%d-%H'), '.json.gz') AS path,
        count(*) * 100 AS bytes, date_trunc('hour', ts) AS hour,
        CASE WHEN bool_or(type = 'ReleaseEvent') THEN 'split' WHEN bool_or(type = 'DeleteEvent') THEN 'landed'
             WHEN bool_or(type = 'IssuesEvent') THEN 'prepared' ELSE 'missing' END AS state
        FROM activity GROUP BY date_trunc('hour', ts)""")
_ISSUE_NEWEST = _newest("issue_history", "event_time DESC, event_id DESC, number DESC NULLS LAST, state DESC, state_reason DESC NULLS LAST, "
                        "comments DESC NULLS LAST, start_time DESC, end_time DESC NULLS LAST")
_TYPE_COUNTS = _A + "SELECT type, count(*) AS events FROM activity GROUP BY type"
_WORDS = "SELECT word, count(*) AS words FROM (SELECT unnest(string_split(text, ' ')) AS word FROM conversations) w GROUP BY word"


def _present(column: str) -> str:
    return f"count(*) FILTER (WHERE {column} <> 'null')"


_PROFILE = {
    **{f"{c}_ratio": _present(c) for c in ("email", "company", "location", "bio", "blog", "hireable", "twitter_username")},
    **{f"{c}_ratio": f"count(*) FILTER (WHERE {c} <> 0)" for c in ("followers", "following", "public_repos", "public_gists")},
    "followers_following_ratio": (
        "count(*) FILTER (WHERE CAST(followers AS DOUBLE) / nullif(following, 0) > 1)"
    ),
}

SQL = {
    "ods_scan": _A + f"""SELECT {_ID}, type, concat('user-', actor_id, {_BOT_SUFFIX}) AS actor_login,
        concat('o/repo-', repo_id) AS repo_name, {_PAYLOAD['payload_action']} AS action,
        CASE WHEN type IN ('IssuesEvent', 'IssueCommentEvent')
             THEN concat('{{"id":', id + 1000000, ',"number":', repo_id, ',"state":"open"}}') END AS issue,
        'true' AS public, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_at FROM activity""",
    "ods_json_files": _A + "SELECT type, count(*) AS events, count(DISTINCT id) AS ids FROM activity GROUP BY type",
    "hour_key": _A + f"SELECT {_ID}, strftime(ts, '%Y-%m-%d-%H') AS time_hour, strftime(ts, '%Y-%m-%d') AS time_day FROM activity",
    "latest_hour": HOUR,
    "time_dim": "SELECT CAST(1700000000.5 AS DOUBLE) AS timestamp_d, strftime(max(ts), '%Y-%m-%d-%H') AS time_hour, "
                "strftime(max(ts), '%Y-%m-%d') AS time_day FROM events",
    "fact_split": _FACT_SPLIT,
    **{f"fact_{name}": _fact(name) for name in FACT_SPECS},
    "issue_dim": ctes("issues") + "SELECT id, state_reason, state, comments, number, start_time, end_time FROM issues",
    "dedupe_events": _A + "SELECT DISTINCT id, type, actor_id, repo_id, ts FROM activity",
    "distinct_activity": _A + "SELECT DISTINCT id, actor_id, repo_id FROM activity",
    "append_new_events": _A + "SELECT id, type, actor_id, repo_id, ts, CAST(ts AS DATE) AS event_date FROM activity "
                              "WHERE ts >= TIMESTAMP '2024-01-21'",
    "event_all_count": _AH + _event_counts(),
    "event_count_latest_hour": _AH + _event_counts(f"WHERE {IN_HOUR}"),
    "event_all_ratio": _event_ratios(),
    "event_ratio_latest_hour": _event_ratios(f"WHERE {IN_HOUR}"),
    "event_trend_hourly": _A + _TREND,
    "user_event_counts": _count_by("actor_id", False),
    "user_event_counts_recent": _count_by("actor_id", True),
    "repo_event_counts": _count_by("repo_id", False),
    "repo_event_counts_recent": _count_by("repo_id", True),
    "dim_counts": "SELECT (SELECT count(DISTINCT o_custkey) FROM orders) AS \"usersCount\", "
                  "(SELECT count(DISTINCT l_partkey) FROM lineitem) AS \"reposCount\"",
    "issue_basic": ctes("issues", hour=HOUR) + f"""SELECT count(*) FILTER (WHERE state = 'open') AS "issueOpenCount",
        count(*) FILTER (WHERE state = 'closed') AS "issueClosedCount",
        count(*) FILTER (WHERE state_reason = 'reopened') AS "issueReopenedCount",
        count(*) FILTER (WHERE state_reason = 'completed') AS "issueCompletedCount",
        count(*) FILTER (WHERE state_reason <> 'completed') AS "issueOtherClosedCount", {STAMP} FROM issues""",
    "issue_state_breakdown": ctes("issues") + """SELECT state, NULL AS state_reason, count(*) AS issues, FALSE AS by_reason
        FROM issues GROUP BY state UNION ALL
        SELECT state, state_reason, count(*), TRUE FROM issues WHERE state = 'closed' GROUP BY state, state_reason""",
    "issue_comment_freq": ctes("issues") + "SELECT comments, count(*) AS issues FROM issues GROUP BY comments",
    "issue_interval_hist": ctes("issues", hour=HOUR) + _INTERVAL_HIST,
    "issue_comments_hist": ctes("issues", hour=HOUR) + f"SELECT {_bands('comments', 'C', _LEVELS, True)}, {STAMP} FROM issues",
    "issue_number_hist": ctes("issues", hour=HOUR) + f"SELECT {_bands('number', 'N', _LEVELS, True)}, {STAMP} FROM issues",
    "profile_ratios": ctes("users", hour=HOUR) + "SELECT "
        + ", ".join(f"round(CAST({test} AS DOUBLE) / nullif(count(*), 0) * 100.0, 2) AS {name}" for name, test in _PROFILE.items())
        + f", {STAMP} FROM users",
    "top20_followers": ctes("users") + "SELECT id, login, followers FROM users ORDER BY followers DESC, id LIMIT 20",
    "top20_following": ctes("users") + "SELECT id, login, following FROM users ORDER BY following DESC, id LIMIT 20",
    "top_active_users": _ranking(
        f"SELECT login, company, location, followers, following, public_repos, activity_cnt, {STAMP} "
        "FROM cnt JOIN cur USING (id) WHERE public_repos > 0", "actor_id", "user_history", _USER_NEWEST, True),
    "top_active_regions": _ranking(_REGIONS, "actor_id", "user_history", _USER_NEWEST, True),
    "top_active_companies": _ranking(_COMPANIES, "actor_id", "user_history", _USER_NEWEST, True),
    "top_active_repos": _ranking(
        f"SELECT cnt.id AS repo_id, cnt.id AS act_id, language, full_name, name, activity_cnt, {STAMP} "
        "FROM cnt JOIN cur ON cnt.id = cur.id", "repo_id", "repo_history", _REPO_NEWEST, True),
    "top_languages": _ranking(
        f"SELECT language, CAST(sum(activity_cnt) AS BIGINT) AS activity_cnt, {STAMP} "
        "FROM cnt JOIN cur USING (id) WHERE language <> 'None' GROUP BY language",
        "repo_id", "repo_history", _REPO_NEWEST, True),
    "top_regions_all_time": _ranking(_REGIONS, "actor_id", "user_history", _USER_NEWEST, False),
    "top_companies_all_time": _ranking(_COMPANIES, "actor_id", "user_history", _USER_NEWEST, False),
    "latest_snapshot_users": ctes("user_history") + _newest("user_history", "updated_at DESC, seq DESC", "* EXCLUDE (rn)"),
    "latest_snapshot_repos": ctes("repo_history") + _newest("repo_history", _REPO_DESC, "* EXCLUDE (rn)"),
    "incremental_since_watermark": ctes("user_history") + f"SELECT * FROM user_history WHERE updated_at > TIMESTAMP '{INCOMING_FROM}'",
    "advance_watermark": "SELECT max(o_orderdate) AS mark, count(*) AS changed_rows FROM orders "
                         f"WHERE o_orderdate > TIMESTAMP '{INCOMING_FROM}'",
    "upsert_users": _upsert("user_history", ["id"], USER_UPDATES, _USER_KEPT, "updated_at DESC, seq DESC", "seq"),
    "upsert_repos": _upsert("repo_history", ["id"], REPO_UPDATES, _REPO_KEPT, _REPO_DESC,
                            "order_seq, line_seq, supp_seq, size, stargazers_count, updated_at"),
    "upsert_buckets_touched": _upsert("user_history", ["id"], USER_UPDATES, _USER_KEPT, "updated_at DESC, seq DESC", "seq"),
    "event_all_count_incremental": _AH + _event_counts(),
    "user_event_counts_incremental": _count_by("actor_id", False),
    "append_indexed": _A + f"SELECT {_ID}, type, actor_id, repo_id, date_trunc('second', ts) AS ts, CAST(ts AS DATE) AS event_date "
                           "FROM activity WHERE day(ts) > 20",
    "rank_users_all_time": ctes("activity", cnt=_per("actor_id", "AND actor_id IS NOT NULL")) + """SELECT id, activity_cnt,
        row_number() OVER (ORDER BY activity_cnt DESC, id) AS position, rank() OVER (ORDER BY activity_cnt DESC) AS rank FROM cnt""",
    "ledger_next": _ARCHIVES + "SELECT path, bytes, hour, state FROM archive WHERE state <> 'split'",
    "ledger_after_round": _ARCHIVES + """SELECT path, bytes, CASE state WHEN 'missing' THEN 'prepared' WHEN 'landed' THEN 'split' ELSE state END AS state
        FROM archive""",
    "issue_basic_current": ctes("issue_history", hour=HOUR, issues=_ISSUE_NEWEST) + f"""SELECT count(*) FILTER (WHERE state = 'open') AS "issueOpenCount",
        count(*) FILTER (WHERE state = 'closed') AS "issueClosedCount", count(*) FILTER (WHERE state_reason = 'reopened') AS "issueReopenedCount",
        count(*) FILTER (WHERE state_reason = 'completed') AS "issueCompletedCount",
        count(*) FILTER (WHERE state_reason <> 'completed') AS "issueOtherClosedCount", {STAMP} FROM issues""",
    "issue_interval_current": ctes("issue_history", hour=HOUR, issues=_ISSUE_NEWEST) + _INTERVAL_HIST,
    "flatten_users": ctes("users") + """SELECT id, login, concat('U_', id) AS node_id, '' AS gravatar_id, 'User' AS type,
        'false' AS site_admin, login AS name, company, blog, location, email, hireable, bio, twitter_username,
        public_repos, public_gists, followers, following, TIMESTAMP '2020-02-03 04:05:06' AS created_at,
        TIMESTAMP '2023-04-12 14:26:29' AS updated_at FROM users""",
    "flatten_repos": f"""SELECT p_partkey AS id, concat('R_', p_partkey) AS node_id, p_name AS name,
        concat(p_brand, '/', p_name) AS full_name, p_size > 45 AS private, CAST(p_size AS BIGINT) AS owner_id,
        p_type AS description, CASE WHEN p_size < 10 THEN 'true' ELSE 'false' END AS fork, {_STAMP_DOC} AS created_at,
        {_STAMP_DOC} AS updated_at, {_STAMP_DOC} AS pushed_at, 'https://example.org' AS homepage,
        CAST(p_size AS BIGINT) AS size, CAST(p_size AS BIGINT) AS stargazers_count, CAST(p_size AS BIGINT) AS watchers_count,
        CASE WHEN p_size % 5 <> 0 THEN p_type END AS language, TRUE AS has_issues, TRUE AS has_projects,
        FALSE AS has_downloads, TRUE AS has_wiki, FALSE AS has_pages, CAST(p_size AS BIGINT) AS forks_count,
        FALSE AS archived, FALSE AS disabled, CAST(p_size AS BIGINT) AS open_issues_count,
        CASE WHEN p_size > 10 THEN p_brand END AS license, CAST(p_size AS BIGINT) AS forks, TRUE AS allow_forking,
        CAST(p_size AS BIGINT) AS open_issues, CAST(p_size AS BIGINT) AS watchers,
        CASE WHEN p_size > 40 THEN CAST(p_size + 100 AS BIGINT) END AS organization_id, {_TOPICS} AS topics,
        'main' AS default_branch FROM part""",
    "topics_list": f"SELECT p_partkey AS id, {_TOPICS} AS topics FROM part",
    "follow_edges": _EDGES,
    "follow_edges_insert": f"SELECT * FROM ({_EDGES}) a EXCEPT SELECT * FROM ({_R_EDGES}) r",
    "exclude_bots": ctes("users") + "SELECT id, login FROM users WHERE NOT contains(login, '[bot]')",
    "refresh_candidates": _A + """SELECT DISTINCT 'user' AS kind, CAST(actor_id AS VARCHAR) AS id,
        concat('user-', actor_id) AS name FROM activity WHERE actor_id % 10 <> 0
        UNION SELECT 'repo', CAST(repo_id AS VARCHAR), concat('o/repo-', repo_id) FROM activity""",
    "missing_hours": _A + """SELECT hour FROM (SELECT unnest(generate_series(date_trunc('hour', min(ts)),
        date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS hour FROM events) c
        WHERE hour NOT IN (SELECT date_trunc('hour', ts) FROM activity WHERE type = 'ReleaseEvent')""",
    "word_count": _WORDS,
    "prune_json": _PRUNED,
    "payload_as_text": _A + f"SELECT {_ID}, TRUE AS public, actor_id, {_PAYLOAD['payload_action']} AS action FROM activity",
    "publish_fanout": ctes("activity", trend=_TREND) + """SELECT hour, type, events, change, 'parquet' AS target FROM trend
        UNION ALL SELECT hour, type, events, change, 'json' FROM trend""",
    "publish_repeated": ctes("activity", trend=_TREND) + "SELECT hour, type, events, change FROM trend",
    "sync_repeated": ctes("user_history") + f"""SELECT *, CASE WHEN updated_at < TIMESTAMP '{STORED_BEFORE}' THEN 'a' ELSE 'b' END AS load_id
        FROM user_history""",
    "land_rejects": _A + """SELECT CASE id % 50 WHEN 0 THEN 'broken' WHEN 1 THEN 'no id' ELSE 'event' END AS reason,
        count(*) AS lines FROM activity GROUP BY 1""",
    "top_regions_recent": _ranking(_REGIONS, "actor_id", "user_history", _USER_NEWEST, False, 10),
    "top_companies_recent": _ranking(_COMPANIES, "actor_id", "user_history", _USER_NEWEST, False, 10),
    "ingest_files_once": "SELECT event_id, ts, user_id, event_type, CAST(ts AS DATE) AS event_date FROM events",
    "stream_parse_flatten": _A + f"""SELECT {_ID}, type, actor_id, concat('user-', actor_id, {_BOT_SUFFIX}) AS actor_login,
        repo_id, concat('o/repo-', repo_id) AS repo_name, concat('https://example.org/repos/', repo_id) AS repo_url,
        date_trunc('second', ts) AS ts FROM activity""",
    "stream_event_window_count": _A + """SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, type, events FROM
        (SELECT date_trunc('hour', ts) AS window_start, type, count(*) AS events FROM activity GROUP BY 1, 2) w""",
    "stream_event_running_count": _TYPE_COUNTS,
    "stream_batch_count": _TYPE_COUNTS,
    "stream_dedupe": _A + "SELECT id, type, actor_id, repo_id, ts FROM activity",
    "stream_counts_compacted": _TYPE_COUNTS,
    "stream_word_count": _WORDS,
}
