"""High-water marks of the incremental loads, kept as a small append-only table."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import HIGH_WATER_MARK

# Fixed value: the mark of a source that was never loaded.
EPOCH = datetime(1970, 1, 1)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can read something there."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition()):
            return False
        raise
    return True


def read_mark(spark: SparkSession, path: str, source: str, load_id: str | None = None) -> datetime:
    """Where a load starts: one value, read to the driver to build the next filter.

    A load that was marked before starts where it did then, whatever came
    after it; a new one starts at the newest mark of the source.
    """
    if not path_exists(spark, path):
        return EPOCH
    marks = spark.read.schema(HIGH_WATER_MARK).parquet(path).where(F.col("source") == source)
    again = F.min(F.when(F.col("load_id") == load_id, F.col("since"))) if load_id else F.lit(None)
    return marks.agg(F.coalesce(again, F.max("mark")).alias("mark")).first()["mark"] or EPOCH


def write_mark(marks: DataFrame, path: str, source: str, load_id: str, since: datetime = EPOCH) -> None:
    """Append the ``mark`` of a one-row frame, and where the load started; a repeated load only repeats the row."""
    start = F.lit(since).cast("timestamp_ntz").alias("since")
    row = marks.select(F.lit(source).alias("source"), "mark", F.lit(load_id).alias("load_id"), start)
    row.write.mode("append").parquet(path)
