"""Which archive hours still have to be fetched, and how far each archive has come."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hour_span(activity: DataFrame) -> DataFrame:
    """First and last hour of the activity, one row."""
    hours = activity.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    return hours.select(
        *[F.date_trunc("hour", c).cast("timestamp_ntz").alias(n) for c, n in (("lo", "first_hour"), ("hi", "last_hour"))]
    )


def missing_hours(span: DataFrame, ledger: DataFrame, n: int | None = None) -> DataFrame:
    """Hours of the span that the ledger lacks, newest first; ``n`` is how many to fetch.

    ``span`` is one row of ``first_hour, last_hour`` and ``ledger`` has a column
    ``hour``, repeats allowed.  The calendar holds 8 784 hours a year at most.
    """
    every = F.sequence("first_hour", "last_hour", F.expr("INTERVAL 1 HOUR"))
    calendar = span.where(F.col("first_hour").isNotNull()).select(F.explode(every).alias("hour"))
    missing = calendar.join(ledger.select("hour").distinct(), "hour", "left_anti").orderBy(F.col("hour").desc())
    return missing if n is None else missing.limit(n)


# How far an archive has come, in order; one that is not in the log is missing.
STATES = ("missing", "prepared", "landed", "split")


def _step(state) -> F.Column:
    return F.array_position(F.array(*[F.lit(s) for s in STATES]), state)


def archive_states(log: DataFrame) -> DataFrame:
    """The furthest state of every archive; repeated and late entries of the log change nothing.

    An archive is its full path and its size: the same name in two folders, and a corrected
    archive of the same path, are archives of their own.
    """
    steps = log.groupBy("path", "bytes").agg(F.max(_step(F.col("state"))).alias("step"))
    return steps.select("path", "bytes", F.element_at(F.array(*[F.lit(s) for s in STATES]), F.col("step").cast("int")).alias("state"))


def pending(available: DataFrame, log: DataFrame, state: str = "split") -> DataFrame:
    """Available archives that have not come to ``state``, with the one they have come to."""
    known = archive_states(log)
    found = available.join(known, ["path", "bytes"], "left").withColumn("state", F.coalesce("state", F.lit(STATES[0])))
    return found.where(_step(F.col("state")) < _step(F.lit(state)))


def next_archives(available: DataFrame, log: DataFrame, n: int, order: str = "hour") -> DataFrame:
    """The ``n`` newest archives that are still missing; ``n`` is the size of a round."""
    missing = pending(available, log, "prepared")
    return missing.orderBy(F.col(order).desc(), "path", "bytes").limit(n).drop("state")


def entries(archives: DataFrame, state: str) -> DataFrame:
    """Rows for the log: these archives have come to ``state``."""
    return archives.select("path", "bytes", F.lit(state).alias("state"))
