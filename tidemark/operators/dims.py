"""User, repository and follow-graph dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import is_bot, quoted_list
from tidemark.functions.time import parse_utc
from tidemark.schemas import FOLLOW_DOC, REPO_DOC, USER_DOC

# Columns that a newer record overwrites; the others keep the
# values of the record that first brought the key in.
USER_UPDATES = ("public_repos", "followers", "following", "created_at", "updated_at")
REPO_UPDATES = (
    "created_at", "updated_at", "pushed_at", "size", "stargazers_count", "watchers_count",
    "forks_count", "open_issues_count", "forks", "open_issues", "watchers",
)

_TIMES = {"created_at", "updated_at", "pushed_at"}


def _member(name: str) -> Column:
    value = F.col(f"doc.{name}")
    return (parse_utc(value) if name in _TIMES else value).alias(name)


def flatten_users(docs: DataFrame, text: str = "doc") -> DataFrame:
    """User documents (JSON text) as typed rows of 20 columns."""
    parsed = docs.select(F.from_json(text, USER_DOC).alias("doc"))
    return parsed.select(*[_member(name) for name in USER_DOC.names])


def flatten_repos(docs: DataFrame, text: str = "doc") -> DataFrame:
    """Repository documents as typed rows of 33 columns; missing sub-objects give NULL."""
    nested = {
        "owner": F.col("doc.owner.id").alias("owner_id"),
        "license": F.col("doc.license.key").alias("license"),
        "organization": F.col("doc.organization.id").alias("organization_id"),
        "topics": quoted_list(F.col("doc.topics")).alias("topics"),
    }
    parsed = docs.select(F.from_json(text, REPO_DOC).alias("doc"))
    return parsed.select(*[nested.get(name) if name in nested else _member(name) for name in REPO_DOC.names])


def follow_edges(docs: DataFrame, text: str = "doc") -> DataFrame:
    """Distinct ``(follower_id, following_id)`` pairs from listing pages.

    A page names its owner and some followers and/or followed users; empty
    listings give no edge.  One scan, both directions.
    """
    parsed = docs.select(F.from_json(text, FOLLOW_DOC).alias("doc"))
    me = F.col("doc.id")
    no_ids = F.array().cast("array<struct<id:bigint>>")
    inward = F.transform(
        F.coalesce("doc.followers", no_ids),
        lambda other: F.struct(other["id"].alias("follower_id"), me.alias("following_id")),
    )
    outward = F.transform(
        F.coalesce("doc.following", no_ids),
        lambda other: F.struct(me.alias("follower_id"), other["id"].alias("following_id")),
    )
    return parsed.select(F.inline(F.concat(inward, outward))).distinct()


def _ordered_row(order: Sequence[str], keep: Sequence[str]) -> Column:
    """The kept columns behind the order columns, so that comparing rows compares the order first."""
    return F.struct(*order, *[name for name in keep if name not in order])


def _one_per_key(pick, history: DataFrame, order: Sequence[str], key: str, keep: Sequence[str] | None) -> DataFrame:
    keep = [name for name in keep or history.columns if name != key]
    picked = history.groupBy(key).agg(pick(_ordered_row(order, keep)).alias("row"))
    return picked.select(key, *[f"row.{name}" for name in keep])


def latest_snapshot(
    history: DataFrame, order: Sequence[str], key: str = "id", keep: Sequence[str] | None = None
) -> DataFrame:
    """Current row per key: the last by ``order``, then by the other columns.

    A partial aggregate keeps one candidate per key and task, so a key with a
    large share of the history does not make a large shuffle partition.
    ``keep`` names the columns wanted, by default all.
    """
    return _one_per_key(F.max, history, order, key, keep)


def first_snapshot(
    history: DataFrame, order: Sequence[str], key: str = "id", keep: Sequence[str] | None = None
) -> DataFrame:
    """Earliest row per key; see :func:`latest_snapshot`."""
    return _one_per_key(F.min, history, order, key, keep)


def changed_since(source: DataFrame, mark, version: str = "updated_at", inclusive: bool = False) -> DataFrame:
    """Rows newer than the mark, or as new; the comparison is pushed to the source."""
    since = F.lit(mark).cast("timestamp_ntz")
    return source.where(F.col(version) >= since if inclusive else F.col(version) > since)


def next_mark(increment: DataFrame, mark, version: str = "updated_at") -> DataFrame:
    """Mark after an increment, and its size; an empty increment keeps the mark."""
    old = F.lit(mark).cast("timestamp_ntz")
    return increment.agg(
        F.coalesce(F.max(version), old).alias("mark"), F.count("*").alias("changed_rows")
    )


def merge_newest(
    stored: DataFrame,
    incoming: DataFrame,
    updates: Sequence[str],
    order: Sequence[str],
    key: str = "id",
    version: str = "updated_at",
) -> DataFrame:
    """Stored rows after an upsert in which the newest version wins.

    ``stored`` has one row per key.  A new key is inserted whole; for a known
    key the ``updates`` columns change only if the incoming version is strictly
    newer.  Several incoming rows of one key act as if applied in ``order``:
    their earliest row supplies the insert, the newest version the update (on
    equal versions the earliest row).  ``order`` columns not in ``stored`` are
    dropped from the result.
    """
    columns = stored.columns
    values = [name for name in columns if name != key]
    # Oldest age is newest version; among equal versions the earliest arrival.
    age = -F.unix_micros(F.col(version).cast("timestamp"))
    newest = F.struct(age.alias("_age"), _ordered_row(order, updates).alias("row"))
    reduced = incoming.groupBy(key).agg(
        F.min(_ordered_row(order, values)).alias("_first"),
        F.min(F.when(F.col(version).isNotNull(), newest))["row"].alias("_newest"),
    )
    joined = stored.withColumn("_known", F.lit(True)).join(reduced, key, "full_outer")
    known = F.col("_known").isNotNull()
    base = F.when(known, F.col(version)).otherwise(F.col(f"_first.{version}"))
    newer = F.col(f"_newest.{version}") > base

    def merged(name: str) -> Column:
        kept = F.when(known, F.col(name)).otherwise(F.col(f"_first.{name}"))
        if name in updates:
            kept = F.when(newer, F.col(f"_newest.{name}")).otherwise(kept)
        return kept.alias(name)

    return joined.select(*[F.col(key) if c == key else merged(c) for c in columns])


def insert_new(incoming: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet; incoming must be unique on ``keys``."""
    return incoming.join(stored.select(*keys), list(keys), "left_anti")


def refresh_candidates(raw: DataFrame) -> DataFrame:
    """Distinct users and repositories named by the activity, without automated accounts.

    Both lookups come out of one scan.  A name that is missing is not a
    candidate: there is nothing to look up.
    """
    lookups = F.array(
        F.struct(F.lit("user").alias("kind"), F.col("actor")["id"].alias("id"), F.col("actor")["login"].alias("name")),
        F.struct(F.lit("repo").alias("kind"), F.col("repo")["id"].alias("id"), F.col("repo")["name"].alias("name")),
    )
    named = raw.select(F.inline(lookups))
    return named.where(~is_bot(F.col("name"))).distinct()


def exclude_bots(df: DataFrame, login: str = "login") -> DataFrame:
    """Rows of non-automated accounts; a missing login is kept."""
    return df.where(~F.coalesce(is_bot(F.col(login)), F.lit(False)))
