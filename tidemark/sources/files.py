"""File readers, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import BROKEN, RAW_EVENT

_TAILED = T.StructType([*RAW_EVENT.fields, T.StructField(BROKEN, T.StringType())])


def read_activity(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """JSON-lines activity, plain or gzip; a broken line gives a row of NULLs."""
    return parse_lines(read_text(spark, path, partitions))


def read_text(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Lines of text.  One gzip archive is one task: ``partitions`` deals its lines over so many."""
    lines = spark.read.text(path)
    return lines if partitions is None else lines.repartition(partitions)


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Activity records out of JSON lines held in a column."""
    return lines.select(F.from_json(line, RAW_EVENT).alias("record")).select("record.*")


def tail_activity(spark: SparkSession, directory: str, **options: str) -> DataFrame:
    """Stream of the JSON-lines files that appear under a directory, each read once.

    A line that is not a record keeps its text in the column ``broken``.
    """
    reader = spark.readStream.schema(_TAILED)
    reader = reader.option("columnNameOfCorruptRecord", BROKEN).option("recursiveFileLookup", "true")
    return reader.options(**options).json(directory)


def tail_lines(spark: SparkSession, directory: str, **options: str) -> DataFrame:
    """Stream of raw lines, shaped like log records (``value``)."""
    return spark.readStream.options(**options).text(directory)


def tail_table(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """Stream over a Parquet table; ``path`` may be one file or a directory.

    The file source takes a directory or a pattern, so the last character is
    turned into a one-character pattern that matches either.
    """
    path = path.rstrip("/")
    return spark.readStream.schema(schema).options(**options).parquet(f"{path[:-1]}[{path[-1]}]")
