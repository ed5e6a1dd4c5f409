"""Appending every event of a stream once, however often and however late it comes.

Copies that come within the lateness are known from the query's state, without reading what is
stored.  Records older than that, which the stateful query drops, are taken by a second query:
only they are compared with the stored rows, and only with those of their own time span.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import folders
from tidemark.streaming.writers import BATCH, read_batches, write_batches

ON_TIME, LATE = "on_time", "late"


def append_once(source: Callable[[], DataFrame], path: str, checkpoint: str, key: str = "id", time: str = "ts", lateness: str = "2 hours") -> None:
    """One round: append the events that ``source()`` has got since the last one, each ``key`` once.

    ``source`` gives the same stream each time.  Records without a key are left out, there is
    nothing to know them by; those without a time are compared with all others of that kind.
    Copies of an event have its time.  A round can be stopped and repeated anywhere.
    """
    stream = source().where(F.col(key).isNotNull())
    schema, spark = stream.schema, stream.sparkSession
    timed = stream.where(F.col(time).isNotNull()).withColumn("_moment", F.col(time).cast("timestamp"))
    fresh = timed.withWatermark("_moment", lateness).dropDuplicatesWithinWatermark([key]).drop("_moment")
    write_batches(fresh, f"{path}/{ON_TIME}", f"{checkpoint}/{ON_TIME}").awaitTermination()

    # What the first query may have dropped: it has seen the newest time, and its watermark is never beyond this bound.
    newest = _rows(spark, path, ON_TIME, schema).agg(F.max(time).alias("t"))
    bound = newest.select((F.col("t") - F.expr(f"INTERVAL {lateness}")).alias("t")).first()["t"]

    def only_new(batch: DataFrame, batch_id: int) -> DataFrame:
        old = F.col(time).isNull() if bound is None else F.col(time).isNull() | (F.col(time) < F.lit(bound))
        late = batch.where(old)
        span = late.agg(F.min(time).alias("low"), F.max(time).alias("high")).first()
        inside = F.col(time).isNull() if span["low"] is None else F.col(time).isNull() | F.col(time).between(F.lit(span["low"]), F.lit(span["high"]))
        stored = _rows(spark, path, ON_TIME, schema).unionByName(_rows(spark, path, LATE, schema, batch_id)).where(inside)
        return late.dropDuplicates([key]).join(stored.select(key), key, "left_anti").select(*schema.names)

    late = source().where(F.col(key).isNotNull())
    write_batches(late, f"{path}/{LATE}", f"{checkpoint}/{LATE}", each_numbered=only_new).awaitTermination()


def _rows(spark: SparkSession, path: str, part: str, schema: T.StructType, but: int | None = None) -> DataFrame:
    if not folders.entries(spark, f"{path}/{part}"):
        return spark.createDataFrame([], schema)
    rows = read_batches(spark, f"{path}/{part}", schema)
    return (rows if but is None else rows.where(F.col(BATCH) != but)).select(*schema.names)


def read_once(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All events appended so far."""
    return _rows(spark, path, ON_TIME, schema).unionByName(_rows(spark, path, LATE, schema))
