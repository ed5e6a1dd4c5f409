"""Publishing a result to several stores."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.hours import stamp_run
from tidemark.session import new_run_dir
from tidemark.sources import folders

MAX_RECORDS_PER_FILE = 5_000_000


@dataclass(frozen=True)
class FileTarget:
    """A folder of Parquet or JSON-lines files."""

    path: str
    format: str = "parquet"
    mode: str = "append"
    partition_by: tuple[str, ...] = ()

    def write(self, df: DataFrame, as_of=None) -> None:
        """Write; with ``as_of``, an appended result has a folder of its own, which a repeated write replaces."""
        own = as_of is not None and self.mode == "append"
        path, mode = (f"{self.path}/as_of={as_of:%Y-%m-%dT%H%M%S}", "overwrite") if own else (self.path, self.mode)
        writer = df.write.format(self.format).mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).save(path)


@dataclass(frozen=True)
class CatalogTarget:
    """A catalog table over a folder: created on the first write, appended to after.

    With ``as_of`` an appended result is a partition of its own, which a repeated write replaces.
    The folder is ``location``, or the table's name in its database's folder.  A catalog that
    doesn't know the table, such as that of a new session without a metastore, is told of a folder
    that an earlier one has filled.
    """

    table: str
    mode: str = "append"
    format: str = "parquet"
    location: str | None = None

    def write(self, df: DataFrame, as_of=None) -> None:
        spark = df.sparkSession
        if self.mode != "append":
            df.write.format(self.format).mode(self.mode).option("path", self._folder(spark)).saveAsTable(self.table)
            return
        partition = None if as_of is None else f"{as_of:%Y-%m-%dT%H%M%S}"
        self._know(spark, df, partition is not None)
        columns = ", ".join(f"`{c}`" for c in spark.table(self.table).columns if partition is None or c != "as_of")
        into = "INTO" if partition is None else "OVERWRITE"
        part = "" if partition is None else f"PARTITION (as_of = '{partition}')"
        spark.sql(f"INSERT {into} TABLE {self.table} {part} SELECT {columns} FROM {{rows}}", rows=df)

    def _folder(self, spark) -> str:
        if self.location:
            return self.location
        database, _, name = self.table.rpartition(".")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database or 'default'}")
        return f"{spark.catalog.getDatabase(database or 'default').locationUri.rstrip('/')}/{name}"

    def _know(self, spark, df: DataFrame, dated: bool) -> None:
        if spark.catalog.tableExists(self.table):
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        dates = (", as_of STRING", "PARTITIONED BY (as_of)") if dated else ("", "")
        folder = self._folder(spark)
        spark.sql(f"CREATE TABLE {self.table} ({columns}{dates[0]}) USING {self.format} {dates[1]} LOCATION '{folder}'")
        if dated and folders.exists(spark, folder):
            spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")


@dataclass(frozen=True)
class ConnectorTarget:
    """A JDBC table, a collection or a topic; ``overwrite`` keeps only the current state.

    An append has no place of its own there: the store tells repeated rows by their ``updated_at``.
    """

    connector: object
    mode: str = "append"

    def write(self, df: DataFrame, as_of=None) -> None:
        if self.connector.format == "kafka":
            df = df.select(F.to_json(F.struct("*")).alias("value"))
        writer = df.write.format(self.connector.format).mode(self.mode)
        writer.options(**self.connector.write_options()).save()


def staged(df: DataFrame, label: str) -> DataFrame:
    """The frame computed once and read back from a table in the shared folder."""
    path = new_run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_RUN = re.compile(r"/tidemark/[^/]+-[0-9a-f]{32}$")


def discard(df: DataFrame) -> None:
    """Remove what :func:`staged` wrote, once nothing reads it any more."""
    for folder in {path.rpartition("/")[0] for path in df.inputFiles()}:
        if _RUN.search(folder):
            folders.delete(df.sparkSession, folder)


def publish(df: DataFrame, targets: Sequence[object], as_of=None) -> None:
    """Write one result to every target.

    With more than one target the result is computed once, into a table in the
    shared folder, and every target reads that table: a lost executor then
    costs a re-read and not a second run, and all targets hold the same rows.
    A repeated call with the same ``as_of`` leaves files and catalog tables as
    they were, also one that follows a stop between two targets.
    """
    if as_of is not None:
        df = stamp_run(df, as_of)
    if len(targets) > 1:
        df = staged(df, "publish")
    for target in targets:
        target.write(df, as_of)
    if len(targets) > 1:
        discard(df)


def stored_rows(spark, target: CatalogTarget) -> int:
    """Rows a catalog table holds now; 0 before its first write."""
    return spark.table(target.table).count() if spark.catalog.tableExists(target.table) else 0


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Even file sizes per partition value at write time.

    The hint lets the adaptive planner split a large value over several tasks
    and merge the small ones, which a plain repartition by column cannot.
    """
    return df.hint("rebalance", *columns)
