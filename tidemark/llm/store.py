"""Reading the tables, and writing intermediate ones where every executor can read them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import new_run_dir, ship_package
from tidemark.sources import folders


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table; its functions run on executors, so the package is sent along."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written under the shared folder and read back: cuts the lineage, survives lost executors."""
    path = f"{new_run_dir(df.sparkSession, label)}/t"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def exchanges_removed(spark: SparkSession) -> Iterator[None]:
    """While this is open, the files of an exchange are removed as soon as its query has ended."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(df: DataFrame) -> None:
    """Remove what :func:`staged` wrote, once nothing reads it any more."""
    for folder in {path.rsplit("/", 2)[0] for path in df.inputFiles()}:
        folders.delete(df.sparkSession, folder)


def smallest_by_hash(df: DataFrame, n: int, *keys: str, seed: int = 0) -> DataFrame:
    """At most ``n`` rows, picked alike in every run: those whose keys hash lowest, in that order."""
    order = F.xxhash64(F.lit(seed), *keys)
    return df.orderBy(order, *keys).limit(n)


def training_fold(doc_id: str = "doc_id"):
    """Rows that labels may be learned from: crc32 of the id as text, modulo 4, is not 2."""
    return ~held_out(doc_id)


def held_out(doc_id: str = "doc_id"):
    """Rows that models are tried on; those without an id aren't."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def calibration(doc_id: str = "doc_id"):
    """A quarter of the training fold that models aren't fitted on, so that thresholds can be set on unseen rows."""
    return F.coalesce((F.crc32(F.col(doc_id).cast("string").cast("binary")) % 16).isin(0, 1, 3), F.lit(False))
