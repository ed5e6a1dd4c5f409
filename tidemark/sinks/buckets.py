"""Current-state tables in hash buckets, of which a round rewrites only those it touches.

The rows lie in a bucketed Parquet table, a folder per version.  A version holds the rows that
its round wrote, and a pointer says for every bucket from which version on its files count::

    root/data/version=7/...        files of the buckets that round 7 wrote
    root/pointer/version=7/...     one row: the first version that counts, by bucket

A round reads the files of the touched buckets, writes these buckets as a new version and then
the pointer, a single file that is there or not: readers see a round whole or not at all, and a
round that stopped is simply run again.  Files that neither the newest pointer nor the one before
it counts are removed, so a reader that began before a round can finish.

Since the files are Spark's own buckets of the key, a join by the key takes the table as it lies:
only the other side is shuffled, into as many partitions as there are buckets.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dims import insert_new, latest_snapshot, merge_newest
from tidemark.sinks.publish import discard, staged
from tidemark.sources import folders

_VERSION = "version"
#: Spark's name of a bucket's file ends in its number.
_BUCKET = re.compile(r"_(\d+)(?:\..*)?$")

Merge = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class Pointer:
    """``since[b]``: the first version whose files of bucket ``b`` count, up to ``version``."""

    version: int
    since: tuple[int, ...]

    def counts(self, bucket: int, version: int) -> bool:
        return self.since[bucket] <= version <= self.version


@dataclass(frozen=True)
class BucketedTable:
    """A table of one row per key (or per key and more), under a folder of its own.

    ``buckets`` is fixed when the table is created: about one per 128 MB of the table's final size.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    key: str = "id"
    buckets: int = 64

    def pointer(self) -> Pointer:
        """The newest complete round; version 0 before the first."""
        return self._pointers()[0]

    def _pointers(self) -> list[Pointer]:
        """The newest pointer and the one before it."""
        none = Pointer(0, (1,) * self.buckets)
        if not folders.entries(self.spark, f"{self.root}/pointer"):
            return [none, none]
        stored = self.spark.read.schema(f"since array<int>, {_VERSION} int").parquet(f"{self.root}/pointer")
        newest = stored.orderBy(F.col(_VERSION).desc()).take(2)
        found = [Pointer(row[_VERSION], tuple(row["since"])) for row in newest]
        if found and len(found[0].since) != self.buckets:
            raise ValueError(f"{self.root} has {len(found[0].since)} buckets, not {self.buckets}")
        return [*found, none, none][:2]

    def bucket_of(self, key: Column) -> Column:
        """The bucket Spark's writer puts a key into."""
        return F.pmod(F.hash(key.cast(self.schema[self.key].dataType)), F.lit(self.buckets))

    def current(self) -> DataFrame:
        """The rows of the newest complete round, in buckets of the key."""
        return self._at(self.pointer())

    def _at(self, pointer: Pointer) -> DataFrame:
        self._register()
        since = F.element_at(F.array(*[F.lit(v) for v in pointer.since]), self.bucket_of(F.col(self.key)) + 1)
        # The first condition prunes folders, the second leaves out rewritten rows whose files still lie there.
        lying = F.col(_VERSION).between(min(pointer.since), pointer.version)
        return self.spark.table(self._name()).where(lying & (F.col(_VERSION) >= since)).drop(_VERSION)

    def files(self, pointer: Pointer | None = None) -> dict[str, tuple[int, int]]:
        """``path: (bucket, version)`` of the files that count."""
        pointer = pointer or self.pointer()
        return {p: at for p, at in self._lying().items() if pointer.counts(*at)}

    def _lying(self) -> dict[str, tuple[int, int]]:
        found = {}
        for folder, _, _ in folders.entries(self.spark, f"{self.root}/data"):
            version = folder.rpartition(f"{_VERSION}=")[2]
            for path, _, _ in folders.entries(self.spark, folder) if version.isdigit() else ():
                if path.endswith(".parquet"):
                    found[path] = (int(_BUCKET.search(path.rpartition("/")[2])[1]), int(version))
        return found

    def upsert(self, incoming: DataFrame, updates: Sequence[str], order: Sequence[str]) -> list[int]:
        """Insert new keys, and let newer versions replace the ``updates`` columns; see :func:`merge_newest`."""
        return self.rewrite(incoming, lambda stored, rows: merge_newest(stored, rows, updates, order, self.key))

    def replace(self, incoming: DataFrame, order: Sequence[str]) -> list[int]:
        """Keep the last row of every key by ``order``.

        Order columns that the table lacks tell incoming rows apart; where the others are equal, an incoming row is later.
        """

        def merge(stored: DataFrame, rows: DataFrame) -> DataFrame:
            rows = rows.select(*stored.columns, *[c for c in order if c not in stored.columns])
            return latest_snapshot(stored.unionByName(rows, allowMissingColumns=True), order, self.key, stored.columns)

        return self.rewrite(incoming, merge)

    def rewrite(self, incoming: DataFrame, merge: Merge) -> list[int]:
        """Write the touched buckets anew as ``merge(stored rows of them, incoming)``; returns these buckets."""
        incoming = staged(incoming, "incoming")
        pointer, touched = self.pointer(), self._touched(incoming)
        if touched:
            stored = self._rows_of([p for p, (b, _) in self.files(pointer).items() if b in touched])
            version = pointer.version + 1
            self._write(merge(stored, incoming), version)
            self._point(Pointer(version, tuple(version if b in touched else v for b, v in enumerate(pointer.since))))
        discard(incoming)
        return sorted(touched)

    def insert(self, incoming: DataFrame, keys: Sequence[str]) -> list[int]:
        """Add rows whose ``keys``, the bucket key among them, are new; only these are written, nothing is rewritten."""
        incoming = staged(incoming, "incoming")
        pointer, touched = self.pointer(), self._touched(incoming)
        if touched:
            stored = self._rows_of([p for p, (b, _) in self.files(pointer).items() if b in touched])
            self._write(insert_new(incoming.dropDuplicates(list(keys)), stored, keys), pointer.version + 1)
            self._point(Pointer(pointer.version + 1, pointer.since))
        discard(incoming)
        return sorted(touched)

    def _touched(self, rows: DataFrame) -> set[int]:
        found = rows.agg(F.collect_set(self.bucket_of(F.col(self.key))).alias("buckets"))
        return set(found.first()["buckets"])

    def _rows_of(self, paths: list[str]) -> DataFrame:
        reader = self.spark.read.schema(self.schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _write(self, rows: DataFrame, version: int) -> None:
        self._register()
        columns = ", ".join(f"`{c}`" for c in self.schema.names)
        spread = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in self.schema]).repartition(self.buckets, self.key)
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self._name()} PARTITION ({_VERSION} = {version}) SELECT {columns} FROM {{rows}}", rows=spread
        )

    def _point(self, pointer: Pointer) -> None:
        row = self.spark.createDataFrame([(list(pointer.since),)], "since array<int>").coalesce(1)
        row.write.mode("overwrite").parquet(f"{self.root}/pointer/{_VERSION}={pointer.version}")
        self._clean()

    def _clean(self) -> None:
        """Remove what neither of the two newest pointers counts."""
        newest, before = self._pointers()
        for path, at in self._lying().items():
            if at[1] <= newest.version and not newest.counts(*at) and not before.counts(*at):
                folders.delete(self.spark, path)
        for folder, _, _ in folders.entries(self.spark, f"{self.root}/pointer"):
            version = folder.rpartition(f"{_VERSION}=")[2]
            if version.isdigit() and int(version) < before.version:
                folders.delete(self.spark, folder)

    def _name(self) -> str:
        return f"state_{hashlib.md5(self.root.encode()).hexdigest()[:16]}"

    def _register(self) -> None:
        """Make the folder known to the session's catalog, whether or not it is new to it."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name()} ({columns}, {_VERSION} INT) USING parquet PARTITIONED BY ({_VERSION}) "
            f"CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.root}/data'"
        )
        if folders.exists(self.spark, f"{self.root}/data"):
            self.spark.sql(f"ALTER TABLE {self._name()} RECOVER PARTITIONS")
