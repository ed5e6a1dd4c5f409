"""Explicit schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())

# Landed activity record. Nested payload values arrive as their JSON text.
RAW_EVENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("actor", _TEXT_MAP),
        T.StructField("repo", _TEXT_MAP),
        T.StructField("payload", _TEXT_MAP),
        T.StructField("public", T.StringType()),
        T.StructField("created_at", T.StringType()),
    ]
)

# The landed layer: the record and the date its folder is named after.
# Column that holds the text of a line which is not a record.
BROKEN = "broken"
LANDED_EVENT = T.StructType([*RAW_EVENT.fields, T.StructField(BROKEN, T.StringType()), T.StructField("event_date", T.DateType())])

# Record as read by the live job: typed actor and repo, the rest left as text.
STREAM_EVENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField(
            "actor",
            T.StructType([T.StructField("id", T.LongType()), T.StructField("login", T.StringType())]),
        ),
        T.StructField(
            "repo",
            T.StructType(
                [
                    T.StructField("id", T.LongType()),
                    T.StructField("name", T.StringType()),
                    T.StructField("url", T.StringType()),
                ]
            ),
        ),
        T.StructField("payload", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("org", T.StringType()),
    ]
)

ISSUE_PAYLOAD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("state_reason", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("comments", T.StringType()),
        T.StructField("number", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("closed_at", T.StringType()),
    ]
)

USER_DOC = T.StructType(
    [T.StructField("id", T.LongType())]
    + [
        T.StructField(name, T.StringType())
        for name in (
            "login", "node_id", "gravatar_id", "type", "site_admin", "name", "company", "blog",
            "location", "email", "hireable", "bio", "twitter_username",
        )
    ]
    + [
        T.StructField(name, T.LongType())
        for name in ("public_repos", "public_gists", "followers", "following")
    ]
    + [T.StructField(name, T.StringType()) for name in ("created_at", "updated_at")]
)

_ID_ONLY = T.StructType([T.StructField("id", T.LongType())])

REPO_DOC = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("node_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("private", T.BooleanType()),
        T.StructField("owner", _ID_ONLY),
        T.StructField("description", T.StringType()),
        T.StructField("fork", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("pushed_at", T.StringType()),
        T.StructField("homepage", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("stargazers_count", T.LongType()),
        T.StructField("watchers_count", T.LongType()),
        T.StructField("language", T.StringType()),
        T.StructField("has_issues", T.BooleanType()),
        T.StructField("has_projects", T.BooleanType()),
        T.StructField("has_downloads", T.BooleanType()),
        T.StructField("has_wiki", T.BooleanType()),
        T.StructField("has_pages", T.BooleanType()),
        T.StructField("forks_count", T.LongType()),
        T.StructField("archived", T.BooleanType()),
        T.StructField("disabled", T.BooleanType()),
        T.StructField("open_issues_count", T.LongType()),
        T.StructField("license", T.StructType([T.StructField("key", T.StringType())])),
        T.StructField("forks", T.LongType()),
        T.StructField("allow_forking", T.BooleanType()),
        T.StructField("open_issues", T.LongType()),
        T.StructField("watchers", T.LongType()),
        T.StructField("organization", _ID_ONLY),
        T.StructField("topics", T.ArrayType(T.StringType())),
        T.StructField("default_branch", T.StringType()),
    ]
)

# One page of a user's follower / following listing.
FOLLOW_DOC = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("followers", T.ArrayType(_ID_ONLY)),
        T.StructField("following", T.ArrayType(_ID_ONLY)),
    ]
)

HIGH_WATER_MARK = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("mark", T.TimestampNTZType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("since", T.TimestampNTZType()),
    ]
)
