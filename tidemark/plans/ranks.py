"""Ranks over a whole table, without one task that sees all of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.sinks.publish import staged

_IN_RANGE = (1 << 33) - 1


def rank_all(df: DataFrame, by: str, ties: Sequence[str], position: str = "position", rank: str = "rank") -> DataFrame:
    """``df`` with its place in the order of ``by`` descending and then ``ties``, and the place its equals by ``by`` share.

    Rows are sorted by ranges.  A row's place is its place in its range behind the rows of the
    ranges before; only the ranges' sizes, a row per range, are added up in one task.  Equal values
    may fill many ranges: their rank is the smallest of their places, reduced in the map tasks
    before it is joined back, and a value that many rows have is split by the adaptive join.
    """
    order = [F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in ties]]
    # A task numbers its rows from its own number shifted by 33 bits on, in the order in which it writes them.
    lined = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    lined = staged(lined.withColumn("_range", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(F.lit(_IN_RANGE))), "ranks")
    before = W.partitionBy(F.lit(1)).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sizes = lined.groupBy("_range").agg(F.count("*").alias("_size"))
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    placed = lined.join(offsets, "_range").withColumn(position, F.col("_offset") + F.col("_at") + 1).drop("_range", "_at", "_offset")
    first = placed.groupBy(F.col(by).alias("_by")).agg(F.min(position).alias(rank))
    return placed.join(first, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")
