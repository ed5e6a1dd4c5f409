"""Stream writers.

A batch goes to a folder named after its number and overwrites it, so a batch
that is replayed after a failure replaces its own output and nothing doubles.
Every query has a checkpoint folder; restarting with the same one continues
where the last run stopped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.sinks.publish import FileTarget
from tidemark.sources import folders

BATCH = "batch_id"
_UPTO = "upto"


def write_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    each: Callable[[DataFrame], DataFrame] | None = None,
    every: str | None = None,
    fold: Callable[[DataFrame], DataFrame] | None = None,
    fold_after: int = 20,
    each_numbered: Callable[[DataFrame, int], DataFrame] | None = None,
) -> StreamingQuery:
    """Start a query whose batches land under ``path``; ``each`` maps a batch before the write, ``each_numbered`` one and its number.

    ``every`` is a processing-time interval such as ``1 minute``; without it
    the query takes what is there and stops.  With ``fold`` the folders of
    ``fold_after`` batches are folded into a snapshot, see :func:`compact`.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id <= _folded(spark, path):
            # A replay of a batch that a snapshot holds: it runs, so that the query's state goes on, and is not written.
            batch.write.format("noop").mode("overwrite").save()
            return
        out = each(batch) if each else each_numbered(batch, batch_id) if each_numbered else batch
        out.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
        if fold and (batch_id + 1) % fold_after == 0:
            compact(spark, path, out.schema, fold)

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(save)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def write_target(stream: DataFrame, target, checkpoint: str, mode: str = "update",
                 each: Callable[[DataFrame], DataFrame] | None = None, every: str = "1 minute") -> StreamingQuery:
    """Send every batch, stamped with the time it ran, to one publishing target.

    In a folder a batch has a place of its own, which a replay overwrites.
    """

    def send(batch: DataFrame, batch_id: int) -> None:
        out = (each(batch) if each else batch).withColumn("updated_at", F.current_timestamp())
        if isinstance(target, FileTarget):
            replace(target, path=f"{target.path}/{BATCH}={batch_id}", mode="overwrite").write(out)
        else:
            target.write(out.withColumn(BATCH, F.lit(batch_id).cast("long")))

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(send).trigger(processingTime=every).start()


def write_console(stream: DataFrame, checkpoint: str, mode: str = "complete", every: str | None = None,
                  rows: int = 1000) -> StreamingQuery:
    """Show the first ``rows`` rows of every batch on the driver's console, to watch a query."""
    writer = stream.writeStream.outputMode(mode).format("console").option("checkpointLocation", checkpoint)
    writer = writer.option("numRows", rows)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def forward_lines(lines: DataFrame, topic, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Send every line (``value``) of a stream to a topic."""
    writer = lines.select("value").writeStream.format(topic.format).options(**topic.write_options())
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def land_files(stream: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = (),
               max_records: int = 5_000_000, every: str | None = None) -> StreamingQuery:
    """Append a stream to a Parquet folder, every source file exactly once.

    No shuffle: a task writes what it read.  Archives arrive in time order, so
    a task touches few partition values.
    """
    writer = (
        stream.writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", checkpoint).option("maxRecordsPerFile", max_records)
        .partitionBy(*partition_by)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path)


def _numbered(spark: SparkSession, path: str, name: str) -> dict[int, str]:
    found = {f.rpartition(f"/{name}=")[2]: f for f, _, _ in folders.entries(spark, path)}
    return {int(number): folder for number, folder in found.items() if number.isdigit()}


def _snapshots(spark: SparkSession, path: str) -> dict[int, str]:
    """Complete snapshots by the last batch they hold."""
    found = _numbered(spark, f"{path}/_snapshots", _UPTO)
    return {n: folder for n, folder in sorted(found.items()) if folders.exists(spark, f"{folder}/_SUCCESS")}


def _folded(spark: SparkSession, path: str) -> int:
    return max(_snapshots(spark, path), default=-1)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Everything written so far, with the batch number of every row: the newest snapshot and the batches after it."""
    schema = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    snapshots = _snapshots(spark, path)
    if not snapshots:
        return spark.read.schema(schema).parquet(path)
    upto = max(snapshots)
    rows = spark.read.schema(schema).parquet(snapshots[upto])
    after = [folder for n, folder in sorted(_numbered(spark, path, BATCH).items()) if n > upto]
    if after:
        rows = rows.unionByName(spark.read.schema(schema).option("basePath", path).parquet(*after))
    return rows


def compact(spark: SparkSession, path: str, schema: T.StructType, fold: Callable[[DataFrame], DataFrame]) -> None:
    """Fold the newest snapshot and the batches after it into a new snapshot.

    ``fold`` maps rows with a batch number to fewer such rows from which the same answers follow,
    for instance :func:`newest_rows`.  A snapshot counts once it is complete; a stop before that
    leaves the old state.  The folders that the snapshot *before* it holds are removed, so a reader
    that began before still finds its files.
    """
    batches, snapshots = _numbered(spark, path, BATCH), _snapshots(spark, path)
    upto = max(batches, default=-1)
    if upto <= max(snapshots, default=-1):
        return
    folded = fold(read_batches(spark, path, schema)).select(*schema.names, BATCH)
    folded.write.mode("overwrite").parquet(f"{path}/_snapshots/{_UPTO}={upto}")
    before = max(snapshots, default=-1)
    for old in [f for n, f in batches.items() if n <= before] + [f for n, f in snapshots.items() if n < before]:
        folders.delete(spark, old)


def newest_rows(key: str | list[str]) -> Callable[[DataFrame], DataFrame]:
    """Fold update-mode batches: of every key the row of the last batch it was in."""
    keys = [key] if isinstance(key, str) else list(key)

    def fold(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in (*keys, BATCH)]
        newest = rows.groupBy(*keys).agg(F.max(F.struct(BATCH, *rest)).alias("row"))
        return newest.select(*keys, *[f"row.{c}" for c in (*rest, BATCH)])

    return fold


def summed_rows(key: str | list[str], value: str) -> Callable[[DataFrame], DataFrame]:
    """Fold batches of their own counts: the sum per key."""
    return lambda rows: rows.groupBy(key).agg(F.sum(value).alias(value), F.max(BATCH).alias(BATCH))


def newest_per_key(batches: DataFrame, key: str | list[str], value: str) -> DataFrame:
    """Current totals out of update-mode batches: the value of the last batch a key was in."""
    return batches.groupBy(key).agg(F.max_by(value, BATCH).alias(value))


def newest_batch(batches: DataFrame) -> DataFrame:
    """Current table out of complete-mode batches: the rows of the last batch."""
    last = batches.agg(F.max(BATCH).alias(BATCH))
    return batches.where(F.col(BATCH) == last.scalar()).drop(BATCH)
