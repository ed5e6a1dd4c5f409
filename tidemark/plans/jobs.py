"""The recurring jobs: prepare, land, split, catch up, collect, sync, upsert, analyse, live.

Each call is one round; the caller's scheduler decides when to run the next.
A round that is repeated, or restarted after a failure, leaves the same tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.json_text import prune_json
from tidemark.functions.time import parse_hour_key, parse_utc
from tidemark.operators.dedupe import new_events, reject_columns, rejected
from tidemark.operators.dims import (
    REPO_UPDATES, USER_UPDATES, changed_since, flatten_repos, flatten_users, follow_edges, latest_snapshot, next_mark,
    refresh_candidates,
)
from tidemark.operators.facts import (
    FACT_SPECS, ISSUE_COLUMNS, fact, fact_columns, is_fact, is_issue, issue_columns, issue_record, issue_snapshots, split_facts,
    time_dim, time_row,
)
from tidemark.operators.hours import latest_loaded_hour
from tidemark.operators.issues import ISSUE_ORDER
from tidemark.operators.ledger import archive_states, entries, hour_span, missing_hours, next_archives
from tidemark.operators.partials import hour_partials, key_partials, loads_of_hours
from tidemark.plans.results import CURRENT_REPO, CURRENT_USER, JOBS, RESULTS, Inputs
from tidemark.schemas import LANDED_EVENT, RAW_EVENT
from tidemark.session import ship_package
from tidemark.sinks.buckets import BucketedTable
from tidemark.sinks.publish import FileTarget, balanced, discard, publish, staged
from tidemark.sources import folders
from tidemark.sources.files import read_text, tail_activity
from tidemark.sources.marks import path_exists, read_mark, write_mark
from tidemark.streaming.records import flatten_records, parse_records, type_counts
from tidemark.streaming.writers import land_files, write_target

#: Buckets of the current dimensions: about one per 128 MB of their final size.
BUCKETS = {"users": 64, "repos": 64}

# Layers that a load fills; their columns are those of the operator, applied to raw records.
LAYERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "facts": split_facts,
    "issue": issue_snapshots,
    "timestable": lambda raw: time_dim(raw, 0.0),
    "rejects": lambda raw: rejected(raw.withColumn("broken", F.lit(None).cast("string"))),
    # What the load adds to the counts over all history.
    "hour_counts": lambda raw: hour_partials(split_facts(raw)),
    "actor_counts": lambda raw: key_partials(split_facts(raw), "actor_id"),
    "repo_counts": lambda raw: key_partials(split_facts(raw), "repo_id"),
}
_LOAD = "load_id"
_SCHEMAS: dict[str, T.StructType] = {}


def layer_schema(spark: SparkSession, name: str) -> T.StructType:
    if name not in _SCHEMAS:
        _SCHEMAS[name] = LAYERS[name](spark.createDataFrame([], RAW_EVENT)).schema
    return _SCHEMAS[name]


@dataclass(frozen=True)
class Warehouse:
    """Where the layers live, under one root folder.

    Every layer has a folder per load, and ``loads`` lists the loads whose layers are all written:
    readers see a load in every layer or in none.
    """

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def has(self, table: str) -> bool:
        return path_exists(self.spark, self.path(table))

    def loads(self) -> list[str]:
        """The finished loads, in order; a load is finished once its row is there, in one file."""
        if not folders.entries(self.spark, self.path("loads")):
            return []
        listed = self.spark.read.schema(f"loaded_at double, {_LOAD} string").parquet(self.path("loads"))
        return sorted(listed.agg(F.collect_set(_LOAD).alias("ids")).first()["ids"])

    def table(self, name: str, loads: Sequence[str] | None = None, keep_load: bool = False) -> DataFrame:
        """A stored table; of a layer all finished loads, or those that are named."""
        if name not in LAYERS:
            return self.spark.read.parquet(self.path(name))
        columns = layer_schema(self.spark, name)
        chosen = self.loads() if loads is None else loads
        schema = T.StructType([*columns.fields, T.StructField(_LOAD, T.StringType())])
        if chosen:
            reader = self.spark.read.schema(schema).option("basePath", self.path(name))
            rows = reader.parquet(*[f"{self.path(name)}/{_LOAD}={load}" for load in chosen])
        else:
            rows = self.spark.createDataFrame([], schema)
        return rows if keep_load else rows.select(*columns.names)

    def fact(self, name: str) -> DataFrame:
        return fact(self.table("facts"), name)

    def current(self, name: str) -> BucketedTable:
        """The current rows of a dimension, see :func:`sync_dimension`."""
        history = self.spark.read.parquet(self.path(name))
        fields = [f for f in history.schema.fields if f.name != _LOAD]
        return BucketedTable(self.spark, self.path(f"current/{name}"), T.StructType(fields), buckets=BUCKETS[name])

    def register_views(self) -> None:
        """Temporary views under the table names analysts use."""
        for name in FACT_SPECS:
            self.fact(name).createOrReplaceTempView(name)
        self.table("issue").select(*ISSUE_COLUMNS).createOrReplaceTempView("issue")
        self.table("timestable").createOrReplaceTempView("timestable")
        for name in ("users", "repos"):
            if self.has(name):
                self.table(name).drop(_LOAD).createOrReplaceTempView(name)

    def hour(self) -> DataFrame:
        """The newest loaded hour, a frame of one row."""
        return latest_loaded_hour(self.table("timestable"))

    def inputs_of_events(self) -> Inputs:
        """What the tables about events alone are computed from; there need be no dimension."""
        none = self.spark.createDataFrame([], "id bigint")
        return Inputs(
            activity=self.table("facts"),
            issues=self.table("issue"),
            issue_order=ISSUE_ORDER,
            users=none,
            repos=none,
            hour=self.hour(),
            unique_events=True,
            date="event_date",
            hours=self.table("hour_counts"),
            actors=self.table("actor_counts"),
            repo_events=self.table("repo_counts"),
        )

    def inputs(self) -> Inputs:
        """What all result tables are computed from: current dimensions where they are kept, else their histories."""
        kept = {name: self.has(f"current/{name}/pointer") for name in ("users", "repos")}
        users, repos = (self.current(name).current() if kept[name] else self.table(name) for name in ("users", "repos"))
        order = ("updated_at", _LOAD)
        return replace(
            self.inputs_of_events(), users=users, repos=repos,
            user_order=None if kept["users"] else order, repo_order=None if kept["repos"] else order,
        )


def archive_folder(path: str, size: int) -> str:
    """Where an archive lands: its name, and a key of its full path and size, so that no two archives share a folder."""
    key = hashlib.md5(f"{path}|{size}".encode()).hexdigest()[:12]
    return f"archive={path.rstrip('/').rpartition('/')[2]}-{key}"


def prepare(spark: SparkSession, archive: str, directory: str, partitions: int | None = None) -> None:
    """Prune an archive (JSON lines, plain or gzip) into a folder of its own under the landing folder.

    A line that is not JSON is passed on as it is, so that nothing is lost.  An
    archive that was prepared to the end is not written again, unless it has
    another size by now; ``partitions`` deals the lines of a gzip archive over so many tasks.
    """
    ship_package(spark)
    out = f"{directory}/{archive_folder(archive, folders.size(spark, archive))}"
    if path_exists(spark, f"{out}/_SUCCESS"):
        return
    lines = read_text(spark, archive, partitions)
    pruned = lines.select(F.coalesce(prune_json(F.col("value")), F.col("value")).alias("value"))
    pruned.write.mode("overwrite").text(out)


def archives(spark: SparkSession, directory: str) -> DataFrame:
    """``path, bytes, hour`` of the archives under a folder; the hour is in the name, as ``2024-01-01-5``."""
    found = spark.createDataFrame(folders.tree(spark, directory), "path string, bytes bigint")
    stamp = F.regexp_extract("path", r"(\d{4}-\d\d-\d\d)-(\d{1,2})[^/]*$", 1)
    hour = F.lpad(F.regexp_extract("path", r"(\d{4}-\d\d-\d\d)-(\d{1,2})[^/]*$", 2), 2, "0")
    return found.withColumn("hour", parse_hour_key(F.concat_ws("-", stamp, hour)))


def archive_log(house: Warehouse) -> DataFrame:
    """The log of archives, ``path, bytes, state``."""
    log = "path string, bytes bigint, state string"
    stored = house.spark.read.schema(log)
    return stored.parquet(house.path("archives")) if house.has("archives") else house.spark.createDataFrame([], log)


def catch_up(house: Warehouse, directory: str, landing: str, n: int, loaded_at: float, partitions: int | None = None) -> int:
    """Prepare the ``n`` newest missing archives of a folder, land and split them; returns how many it took.

    Every step is logged when it is done.  A round that stopped is taken up where it stopped:
    what was prepared is landed and split by the next one, and nothing is prepared twice.
    """
    spark = house.spark

    def log(rows: DataFrame, state: str) -> None:
        entries(rows, state).coalesce(1).write.mode("append").parquet(house.path("archives"))

    available = archives(spark, directory)
    chosen = next_archives(available, archive_log(house), n).agg(F.collect_list(F.struct("path", "bytes")).alias("rows")).first()["rows"]
    for path, size in chosen:
        prepare(spark, path, landing, partitions)
        log(spark.createDataFrame([(path, size)], "path string, bytes bigint"), "prepared")
    for step, state in ((lambda: land(house, landing), "landed"), (lambda: split_landed(house, loaded_at), "split")):
        before = archive_states(archive_log(house)).where(F.col("state") == ("prepared" if state == "landed" else "landed"))
        moved = staged(before, "moved")
        step()
        log(moved, state)
        discard(moved)
    return len(chosen)


PROFILES = {"users": (flatten_users, USER_UPDATES), "repos": (flatten_repos, REPO_UPDATES)}
EDGES = T.StructType([T.StructField("follower_id", T.LongType()), T.StructField("following_id", T.LongType())])


def profiles(house: Warehouse, name: str) -> BucketedTable:
    """The table of fetched user or repository records."""
    flatten, _ = PROFILES[name]
    schema = flatten(house.spark.createDataFrame([], "doc string")).schema
    return BucketedTable(house.spark, house.path(f"profiles/{name}"), schema, buckets=BUCKETS[name])


def follows(house: Warehouse) -> BucketedTable:
    return BucketedTable(house.spark, house.path("profiles/follows"), EDGES, key="follower_id", buckets=BUCKETS["users"])


def collect(house: Warehouse, name: str, docs: DataFrame) -> list[int]:
    """Store fetched documents (``doc``): ``users`` and ``repos`` are upserted, ``follows`` pages add edges.

    Documents without an id are left out.  Returns the buckets that were touched.
    """
    if name == "follows":
        edges = follow_edges(docs).where("follower_id is not null and following_id is not null")
        return follows(house).insert(edges, EDGES.names)
    flatten, updates = PROFILES[name]
    rows = flatten(docs).where("id is not null")
    return profiles(house, name).upsert(rows, updates, ["updated_at"])


def to_refresh(house: Warehouse) -> DataFrame:
    """``kind, id, name`` of the users and repositories that the raw activity names and no profile is stored of."""
    found = refresh_candidates(house.table("ods"))
    for kind in ("user", "repo"):
        if house.has(f"profiles/{kind}s/pointer"):
            stored = profiles(house, f"{kind}s").current().select(F.col("id").cast("string").alias("id"), F.lit(kind).alias("kind"))
            found = found.join(stored, ["kind", "id"], "left_anti").select("kind", "id", "name")
    return found


def hours_without_events(house: Warehouse) -> DataFrame:
    """``hour``, newest first, of which no load has an event, between the first and the last that one has."""
    hours = house.table("hour_counts").where("hour is not null")
    return missing_hours(hour_span(hours.select(F.col("hour").alias("ts"))), hours)


def land(house: Warehouse, directory: str, **options: str) -> None:
    """Move new JSON files into the raw layer, each file once."""
    raw = tail_activity(house.spark, directory, **options)
    dated = raw.withColumn("event_date", F.to_date(parse_utc(F.col("created_at"))))
    query = land_files(dated, house.path("ods"), house.path("_checkpoints/ods"), ("event_date",))
    query.awaitTermination()


def split(house: Warehouse, raw: DataFrame, load_id: str, loaded_at: float) -> None:
    """Turn one increment of raw records into the layers of a load, which become visible together.

    The records are read and parsed once.  Events and issue records that another finished load
    has are left out; of the older loads only those are read that hold events of the same hours.
    A load that is repeated, or was stopped before its end, replaces what it has written.
    """
    parsed = staged(_parsed(raw), "parsed")
    facts = parsed.where("fact is not null").select("fact.*")
    earlier = [load for load in house.loads() if load != load_id]
    hours = house.table("hour_counts", earlier, keep_load=True)
    alike = loads_of_hours(hours, facts).agg(F.collect_set(_LOAD).alias("ids")).first()["ids"]
    _write_load(balanced(new_events(facts, house.table("facts", alike)), "event_date", "type"), house, "facts", load_id, ("event_date", "type"))
    # An issue record is an event: it is stored where its event is.
    issues = parsed.where("issue is not null").select("issue.*")
    _write_load(balanced(new_events(issues, house.table("issue", alike), "event_id"), "event_date"), house, "issue", load_id, ("event_date",))
    _write_load(time_row(parsed.select("ts"), loaded_at), house, "timestable", load_id)
    _write_load(parsed.where("reject is not null").select("reject.*"), house, "rejects", load_id)

    written = house.spark.read.schema(layer_schema(house.spark, "facts")).parquet(f"{house.path('facts')}/{_LOAD}={load_id}")
    for name, partials in (
        ("hour_counts", hour_partials(written)), ("actor_counts", key_partials(written, "actor_id")), ("repo_counts", key_partials(written, "repo_id"))
    ):
        _write_load(partials, house, name, load_id)
    done = house.spark.range(1).select(F.lit(float(loaded_at)).alias("loaded_at")).coalesce(1)
    done.write.mode("overwrite").parquet(f"{house.path('loads')}/{_LOAD}={load_id}")
    discard(parsed)


def _parsed(raw: DataFrame) -> DataFrame:
    """Every raw record once: its time, and what it is a row of."""
    if "broken" not in raw.columns:
        raw = raw.withColumn("broken", F.lit(None).cast("string"))
    # The time is in five columns of the rows: it is parsed once for all of them, as the issue is.
    record = raw.select("*", parse_utc(F.col("created_at")).alias("_ts"), F.when(is_issue(), issue_record()).alias("issue"))
    ts = F.col("_ts")
    return record.select(
        ts.alias("ts"),
        F.when(is_fact(), F.struct(*fact_columns(ts))).alias("fact"),
        F.when(is_issue(), F.struct(*issue_columns(ts))).alias("issue"),
        F.when(F.col("broken").isNotNull() | F.col("id").isNull(), F.struct(*reject_columns(raw.columns))).alias("reject"),
    )


def split_landed(house: Warehouse, loaded_at: float) -> None:
    """:func:`split` over what was landed since the last round, each raw file once."""
    raw = house.spark.readStream.schema(LANDED_EVENT).parquet(house.path("ods"))

    def load(batch: DataFrame, batch_id: int) -> None:
        split(house, batch, f"{batch_id:09d}", loaded_at)

    query = (
        raw.writeStream.option("checkpointLocation", house.path("_checkpoints/split"))
        .trigger(availableNow=True).foreachBatch(load).start()
    )
    query.awaitTermination()


def _write_load(rows: DataFrame, house: Warehouse, table: str, load_id: str, partition_by: tuple[str, ...] = ()) -> None:
    target = FileTarget(f"{house.path(table)}/{_LOAD}={load_id}", mode="overwrite", partition_by=partition_by)
    target.write(rows)


def _replace_load(df: DataFrame, path: str, load_id: str) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{_LOAD}={load_id}")


def sync_dimension(
    house: Warehouse,
    name: str,
    fetch: Callable[[datetime], DataFrame],
    load_id: str,
) -> None:
    """Append the records changed since the last round to a dimension's history.

    ``fetch`` gets the mark and returns the records that are newer or as new,
    for instance ``lambda mark: read_since(spark, table, mark)``; those of the
    mark's own moment that another load has stored are left out.  The records
    are written once and the next mark is taken from what was written, so a row
    changed meanwhile is neither lost nor marked as read.  A load that is
    repeated starts where it did the first time and replaces its own records.

    The current rows are kept besides, in buckets of which a load rewrites
    those that it touches; the newest record of an id is its current row.
    """
    marks = house.path("_marks")
    mark = read_mark(house.spark, marks, name, load_id)
    fetched = fetch(mark)
    if house.has(name):
        at_mark = F.col("updated_at") == F.lit(mark).cast("timestamp_ntz")
        history = house.spark.read.schema(T.StructType([*fetched.schema.fields, T.StructField("load_id", T.StringType())]))
        known = history.parquet(house.path(name)).where(at_mark & (F.col("load_id") != load_id)).select("id", "updated_at")
        fetched = fetched.join(known, ["id", "updated_at"], "left_anti").select(*fetched.columns)
    fetched = staged(fetched, name)
    _replace_load(fetched, house.path(name), load_id)
    discard(fetched)
    written = house.spark.read.schema(fetched.schema).parquet(f"{house.path(name)}/{_LOAD}={load_id}")
    house.current(name).replace(written, ["updated_at"])
    write_mark(next_mark(written, mark), marks, name, load_id, mark)


def sync_table(house: Warehouse, name: str, source: DataFrame, load_id: str) -> None:
    """:func:`sync_dimension` from a frame that holds the whole current table."""
    sync_dimension(house, name, lambda mark: changed_since(source, mark, inclusive=True), load_id)


def upsert_dimension(
    house: Warehouse, name: str, incoming: DataFrame, updates: Sequence[str], order: Sequence[str], buckets: int = 64
) -> DataFrame:
    """Merge fetched records into a current-state table; returns its rows.

    A call rewrites the buckets of the incoming keys only.  One that is
    repeated, or that comes late, changes nothing: only newer versions do.
    """
    columns = [c for c in incoming.columns if c not in order or c in updates]
    table = BucketedTable(house.spark, house.path(name), incoming.select(*columns).schema, buckets=buckets)
    table.upsert(incoming, updates, order)
    return table.current()


def with_current_dimensions(inputs: Inputs, jobs: Iterable[str]) -> Inputs:
    """Inputs whose histories are reduced to current rows once, for the jobs that share them.

    Six tables use the current users and two the current repositories; without
    this each would aggregate the whole history again.
    """
    jobs = set(jobs)
    if jobs & {"users", "user_activity", "dashboard_rankings"} and inputs.user_order is not None:
        users = latest_snapshot(inputs.users, inputs.user_order, keep=CURRENT_USER)
        inputs = replace(inputs, users=staged(users, "users"), user_order=None)
    if "repo_activity" in jobs and inputs.repo_order is not None:
        repos = latest_snapshot(inputs.repos, inputs.repo_order, keep=CURRENT_REPO)
        inputs = replace(inputs, repos=staged(repos, "repos"), repo_order=None)
    return inputs


def analyse(
    inputs: Inputs,
    targets: Callable[[str], Sequence[object]],
    as_of: datetime,
    jobs: Sequence[str] = tuple(JOBS),
) -> None:
    """Compute and publish the result tables of the given jobs."""
    given, inputs = inputs, with_current_dimensions(inputs, jobs)
    for job in jobs:
        for name in JOBS[job]:
            publish(RESULTS[name](inputs), targets(name), as_of)
    for reduced, before in ((inputs.users, given.users), (inputs.repos, given.repos)):
        if reduced is not before:
            discard(reduced)


def live(log: DataFrame, target, checkpoint: str, every: str = "1 minute"):
    """Count the events of every micro-batch by type and send ``type, count, updated_at, batch_id`` to a target.

    A folder gets a batch once, however often it is replayed; a store gets the
    batch number, by which it can replace the rows of a replayed batch.
    """
    flat = flatten_records(parse_records(log))

    def counts(batch: DataFrame) -> DataFrame:
        return type_counts(batch).withColumnRenamed("events", "count")

    return write_target(flat, target, checkpoint, mode="append", each=counts, every=every)
