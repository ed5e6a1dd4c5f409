"""Word counts over text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def words(lines: DataFrame, text: str = "value") -> DataFrame:
    """One row per space-separated word; two spaces in a row give an empty word."""
    return lines.select(F.explode(F.split(text, " ")).alias("word"))


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    return words(lines, text).groupBy("word").agg(F.count("*").alias("words"))
