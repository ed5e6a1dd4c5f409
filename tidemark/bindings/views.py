"""The provided tables in the shape of the operators' inputs.

A view is one SELECT over ``{table}`` names.  Spark runs it as it stands; the
SQL that results are compared with uses the same text as a CTE.  ``JSON_K`` is
the one expression the two engines spell differently.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time import iso_utc

SPARK_JSON_K = "get_json_object(props, '$.k')"
ANSI_JSON_K = "json_extract_string(props, '$.k')"

VIEWS = {
    "activity": """
        SELECT event_id AS id,
               CASE WHEN event_type IN ('view', 'signup') THEN 'PushEvent'
                    WHEN event_type = 'click' AND value < 35 THEN 'WatchEvent'
                    WHEN event_type = 'click' THEN 'CreateEvent'
                    WHEN event_type = 'error' AND value < 35 THEN 'IssuesEvent'
                    WHEN event_type = 'error' THEN 'IssueCommentEvent'
                    WHEN value < 20 THEN 'DeleteEvent'
                    WHEN value < 70 THEN 'PullRequestEvent'
                    ELSE 'ReleaseEvent' END AS type,
               user_id AS actor_id, CAST(JSON_K AS BIGINT) AS repo_id, ts
        FROM {events}""",
    "users": """
        SELECT c_custkey AS id,
               CASE WHEN c_nationkey = 7 THEN concat(c_name, '[bot]') ELSE c_name END AS login,
               CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS company,
               CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN n_name
                    ELSE concat(' ', c_mktsegment, ' ,  ', n_name, ' ') END AS location,
               CASE WHEN c_acctbal < 0 THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN 'null'
                    WHEN c_mktsegment = 'FURNITURE' THEN '' ELSE concat(c_name, '@example.org') END AS email,
               CASE WHEN c_acctbal > 5000 THEN concat('works in ', n_name) END AS bio,
               CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'null' ELSE '' END AS blog,
               CASE WHEN c_acctbal > 7500 THEN 'true' END AS hireable,
               CASE WHEN c_nationkey < 12 THEN c_name END AS twitter_username,
               CAST(greatest(floor(c_acctbal), 0) AS BIGINT) AS followers,
               c_custkey % 7 AS following, c_custkey % 5 AS public_repos, c_custkey % 3 AS public_gists
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "issues": """
        SELECT o_orderkey AS id, o_orderkey AS number,
               CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'closed' END AS state,
               CASE WHEN o_orderstatus = 'F' THEN 'completed'
                    WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'reopened'
                    WHEN o_orderstatus = 'P' THEN 'not_planned' END AS state_reason,
               coalesce(n, 0) AS comments, o_orderdate AS start_time,
               CASE WHEN o_orderstatus <> 'O' THEN e END AS end_time
        FROM {orders} LEFT JOIN (SELECT l_orderkey, count(*) AS n, max(l_shipdate) AS e
                                 FROM {lineitem} GROUP BY l_orderkey) x ON o_orderkey = l_orderkey""",
    "issue_history": """
        SELECT l_orderkey AS id, l_partkey AS number,
               CASE WHEN l_linestatus = 'O' THEN 'open' ELSE 'closed' END AS state,
               CASE WHEN l_returnflag = 'R' THEN 'not_planned' WHEN l_returnflag = 'A' AND l_linenumber > 3 THEN 'reopened'
                    WHEN l_returnflag = 'A' THEN 'completed' END AS state_reason,
               CAST(l_quantity AS BIGINT) AS comments, o_orderdate AS start_time,
               CASE WHEN l_linestatus <> 'O' THEN l_shipdate END AS end_time,
               l_shipdate AS event_time, l_linenumber AS event_id
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "user_history": """
        SELECT o_custkey AS id,
               concat('user-', CAST(o_custkey AS STRING), '-', o_orderpriority) AS login,
               CASE WHEN o_orderpriority = '1-URGENT' THEN NULL WHEN o_orderpriority = '2-HIGH' THEN 'None'
                    ELSE o_orderpriority END AS company,
               CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority = '5-LOW' THEN 'None'
                    WHEN o_orderpriority = '1-URGENT' THEN concat('  Y', CAST(year(o_orderdate) AS STRING))
                    ELSE concat(' ', o_orderpriority, ' ,  Y', CAST(year(o_orderdate) AS STRING), ' ')
                    END AS location,
               CAST(floor(o_totalprice) AS BIGINT) AS followers,
               CAST(floor(o_totalprice / 100) AS BIGINT) AS following,
               CASE WHEN o_orderstatus = 'O' THEN CAST(floor(o_totalprice / 100000) AS BIGINT) ELSE 3 END AS public_repos,
               o_orderdate AS created_at, o_orderdate AS updated_at, o_orderkey AS seq
        FROM {orders}""",
    "repo_history": """
        SELECT l_partkey AS id,
               concat('part-', CAST(l_partkey AS STRING)) AS name,
               concat('s', CAST(l_suppkey AS STRING), '/part-', CAST(l_partkey AS STRING)) AS full_name,
               CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN 'None'
                    ELSE concat('lang', CAST(l_linenumber AS STRING)) END AS language,
               l_shipdate AS created_at, l_shipdate AS updated_at, l_shipdate AS pushed_at,
               CAST(l_quantity AS BIGINT) AS size, CAST(floor(l_extendedprice) AS BIGINT) AS stargazers_count,
               CAST(floor(l_extendedprice) AS BIGINT) AS watchers_count, l_suppkey AS forks_count,
               l_linenumber AS open_issues_count, l_suppkey AS forks, l_linenumber AS open_issues,
               CAST(floor(l_extendedprice) AS BIGINT) AS watchers,
               l_orderkey AS order_seq, l_linenumber AS line_seq, l_suppkey AS supp_seq
        FROM {lineitem}""",
}

USER_ORDER = ("updated_at", "seq")
REPO_ORDER = ("updated_at", "order_seq", "line_seq", "supp_seq", "size", "stargazers_count")

_TABLE = re.compile(r"\{(\w+)\}")

# Column types of the provided tables, so that no footer is read to find them.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def spark_view(spark: SparkSession, name: str, **tables: DataFrame) -> DataFrame:
    """A view over the given frames, batch or streaming."""
    return spark.sql(VIEWS[name].replace("JSON_K", SPARK_JSON_K), **tables)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over the provided tables."""
    return spark_view(spark, name, **{n: table(spark, sf_dir, n) for n in set(_TABLE.findall(VIEWS[name]))})


#: The provided tables are a file of one row group each, so one task would read, render and parse
#: them.  The views that render documents deal their rows out first, over so many tasks at least.
FIXTURE_PARTITIONS = 16
#: On more cores, tasks for each of them: with hardly more tasks than cores, most cores would wait for the last ones.
TASKS_PER_CORE = 3


def dealt(df: DataFrame) -> DataFrame:
    return df.repartition(max(FIXTURE_PARTITIONS, TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism))


def ctes(*names: str, **more: str) -> str:
    """``WITH`` clause of views and further named queries for the comparison SQL."""
    parts = [f"{n} AS ({_TABLE.sub(r'\1', VIEWS[n]).replace('JSON_K', ANSI_JSON_K)})" for n in names]
    parts += [f"{n} AS ({sql})" for n, sql in more.items()]
    return "WITH " + ",\n".join(parts) + "\n"


_REF_TYPES = ("CreateEvent", "DeleteEvent")
_ISSUE_TYPES = ("IssuesEvent", "IssueCommentEvent")


def _payload(kind: F.Column, key: F.Column, n: F.Column) -> list[F.Column]:
    """Payload members of a record of each type; NULL where the type lacks one."""

    def only(types: tuple[str, ...], value: F.Column) -> F.Column:
        return F.when(kind.isin(*types), value)

    action = (
        F.when(kind == "IssuesEvent", "opened").when(kind == "IssueCommentEvent", "created")
        .when(kind == "PullRequestEvent", "closed").when(kind == "ReleaseEvent", "published")
        .when(kind == "WatchEvent", "started")
    )
    issue = F.struct((n + 1000000).alias("id"), key.alias("number"), F.lit("open").alias("state"))
    return [
        only(_REF_TYPES, F.concat(F.lit("b"), key.cast("string"))).alias("ref"),
        only(_REF_TYPES, F.lit("branch")).alias("ref_type"),
        only(("CreateEvent",), F.lit("main")).alias("master_branch"),
        only(("CreateEvent",), F.when(key > 50, F.concat(F.lit("repo "), key.cast("string")))).alias("description"),
        only(_REF_TYPES, F.lit("user")).alias("pusher_type"),
        action.alias("action"),
        only(_ISSUE_TYPES, issue).alias("issue"),
        only(("PullRequestEvent",), key).alias("number"),
        only(("PushEvent",), n + 5000000).alias("push_id"),
        only(("PushEvent",), key).alias("size"),
        only(("PushEvent",), key + 1).alias("distinct_size"),
        only(("ReleaseEvent",), F.struct((n + 7000000).alias("id"))).alias("release"),
    ]


def _record(activity: DataFrame) -> DataFrame:
    """The activity view as archive records, links included so that pruning has work to do."""
    kind, key, n = F.col("type"), F.col("repo_id"), F.col("id")
    actor_id, repo_id = F.col("actor_id").cast("string"), key.cast("string")
    bot = F.when(F.col("actor_id") % 10 == 0, F.lit("[bot]")).otherwise(F.lit(""))
    actor = F.struct(
        F.col("actor_id").alias("id"),
        F.concat(F.lit("user-"), actor_id, bot).alias("login"),
        F.concat(F.lit("https://example.org/users/"), actor_id).alias("url"),
    )
    repo = F.struct(
        key.alias("id"),
        F.concat(F.lit("o/repo-"), repo_id).alias("name"),
        F.concat(F.lit("https://example.org/repos/"), repo_id).alias("url"),
    )
    return activity.select(
        n.cast("string").alias("id"), "type", actor.alias("actor"), repo.alias("repo"),
        F.struct(*_payload(kind, key, n)).alias("payload"), F.lit(True).alias("public"),
        iso_utc(F.col("ts")).alias("created_at"),
    )


def activity_lines(activity: DataFrame) -> DataFrame:
    """Archive records as raw JSON lines (``value``)."""
    return _record(activity if activity.isStreaming else dealt(activity)).select(F.to_json(F.struct("*")).alias("value"))


def _text_map(struct: str, members: list[str], nested: tuple[str, ...] = ()) -> F.Column:
    pairs = []
    for name in members:
        value = F.col(f"{struct}.{name}")
        pairs += [F.lit(name), F.to_json(value) if name in nested else value.cast("string")]
    return F.create_map(*pairs).alias(struct)


def ods_rows(activity: DataFrame) -> DataFrame:
    """Archive records as the landed layer holds them: text maps, nested values as JSON text."""
    records = _record(dealt(activity))
    return records.select(
        "id", "type", _text_map("actor", ["id", "login"]), _text_map("repo", ["id", "name"]),
        _text_map("payload", records.schema["payload"].dataType.names, ("issue", "release")),
        F.col("public").cast("string").alias("public"), "created_at",
    )


def issue_rows(issues: DataFrame) -> DataFrame:
    """The issues view as landed issue records."""
    issue = F.struct(
        "id", "state_reason", "state", "comments", "number",
        iso_utc(F.col("start_time")).alias("created_at"), iso_utc(F.col("end_time")).alias("closed_at"),
    )
    return issues.select(
        F.concat(F.lit("e"), F.col("id").cast("string")).alias("id"), F.lit("IssuesEvent").alias("type"),
        F.create_map(F.lit("action"), F.lit("opened"), F.lit("issue"), F.to_json(issue)).alias("payload"),
        iso_utc(F.col("start_time")).alias("created_at"),
    )


def user_docs(users: DataFrame) -> DataFrame:
    """The users view as user documents (``doc``)."""
    doc = F.struct(
        "*", F.lit("2020-02-03T04:05:06Z").alias("created_at"), F.lit("2023-04-12T14:26:29Z").alias("updated_at"),
        F.concat(F.lit("U_"), F.col("id").cast("string")).alias("node_id"), F.lit("").alias("gravatar_id"),
        F.lit("User").alias("type"), F.lit(False).alias("site_admin"), F.col("login").alias("name"),
    )
    return dealt(users).select(F.to_json(doc).alias("doc"))


def repo_docs(part: DataFrame) -> DataFrame:
    """Parts as repository documents (``doc``), some without license, organization or topics."""
    size = F.col("p_size")
    day = F.lpad((size % 28 + 1).cast("string"), 2, "0")
    stamp = F.concat(F.lit("2021-03-"), day, F.lit("T10:00:29Z"))
    topics = F.when(size > 25, F.transform(F.sequence(F.lit(1), size), lambda i: F.concat(F.lit("t"), i.cast("string"))))
    doc = F.struct(
        F.col("p_partkey").alias("id"), F.concat(F.lit("R_"), F.col("p_partkey").cast("string")).alias("node_id"),
        F.col("p_name").alias("name"), F.concat("p_brand", F.lit("/"), "p_name").alias("full_name"),
        (size > 45).alias("private"), F.struct(size.alias("id"), F.lit("own").alias("login")).alias("owner"),
        F.col("p_type").alias("description"), (size < 10).alias("fork"),
        stamp.alias("created_at"), stamp.alias("updated_at"), stamp.alias("pushed_at"),
        F.lit("https://example.org").alias("homepage"), size.alias("size"), size.alias("stargazers_count"),
        size.alias("watchers_count"), F.when(size % 5 != 0, F.col("p_type")).alias("language"),
        F.lit(True).alias("has_issues"), F.lit(True).alias("has_projects"), F.lit(False).alias("has_downloads"),
        F.lit(True).alias("has_wiki"), F.lit(False).alias("has_pages"), size.alias("forks_count"),
        F.lit(False).alias("archived"), F.lit(False).alias("disabled"), size.alias("open_issues_count"),
        F.when(size > 10, F.struct(F.col("p_brand").alias("key"), F.lit("n").alias("name"))).alias("license"),
        size.alias("forks"), F.lit(True).alias("allow_forking"), size.alias("open_issues"), size.alias("watchers"),
        F.when(size > 40, F.struct((size + 100).alias("id"))).alias("organization"),
        F.when(size == 1, F.array().cast("array<string>")).otherwise(topics).alias("topics"),
        F.lit("main").alias("default_branch"),
    )
    return dealt(part).select(F.to_json(doc).alias("doc"))


def follow_docs(lineitem: DataFrame) -> DataFrame:
    """Lineitems as listing pages: a supplier's followers and followed users, some listings empty."""
    def ids(*columns) -> F.Column:
        return F.array(*[F.struct(c.alias("id")) for c in columns])

    no_ids = F.array().cast("array<struct<id:bigint>>")
    followers = F.when(F.col("l_returnflag") == "N", no_ids).otherwise(ids(F.col("l_partkey")))
    doc = F.struct(
        F.col("l_suppkey").alias("id"), followers.alias("followers"),
        F.when(F.col("l_linestatus") == "O", ids(F.col("l_orderkey"), F.col("l_partkey"))).alias("following"),
    )
    return dealt(lineitem).select(F.to_json(doc).alias("doc"))


def page_docs(pages: DataFrame) -> DataFrame:
    """Pages as nested documents with links, empty containers and objects that empty out."""
    no_text = F.array().cast("array<string>")
    doc = F.struct(
        F.col("page_id").alias("id"), F.col("url").alias("link"), F.col("html"),
        F.length("html").alias("size"), no_text.alias("tags"),
        F.array("url", F.lit("plain")).alias("links"),
        F.struct(F.col("url").alias("href")).alias("emptied"),
        F.struct(
            F.struct(F.col("url").alias("self"), F.col("page_id").alias("n"), no_text.alias("none")).alias("inner"),
            F.array(F.struct(F.col("url").alias("u"), F.lit(1).alias("k"))).alias("items"),
        ).alias("meta"),
    )
    return dealt(pages).select("page_id", F.to_json(doc).alias("doc"))
