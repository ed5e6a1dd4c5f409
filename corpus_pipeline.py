"""The corpus pipeline: five of the operators in sequence.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and read
again as the next one's ``docs``.  All stages but the last return the columns of ``docs``.

Nulls in any column, empty texts and empty tables pass through every stage.  Rows of equal id
are separate documents until the near-duplicate stage, which keeps one of each group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, mixing, neardup, secrets
from tidemark.llm.store import staged, table, training_fold
from tidemark.session import ship_package


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; those without a letter go, and those mixed beyond use."""
    ship_package(spark)
    model = langid.fit(docs.filter(training_fold()))
    judged = langid.identify(docs, model)
    kept = judged.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("lang_score") >= 0.4))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, one with the smallest id."""
    ship_package(spark)
    found = neardup.near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    kept = docs.join(found, same, "left_semi")
    return kept.withColumn("_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "_hash"]).drop("_hash")


def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark windows cut out of the texts; a document of which no word is left goes."""
    before = docs.withColumn("_text", F.col("text"))
    clean = decontaminate.remove(spark, before, table(spark, sf_dir, "benchmark"))
    changed = F.coalesce(F.col("text") != F.col("_text"), F.lit(False))
    kept = clean.filter(~changed | F.col("text").rlike(r"[\p{L}\p{N}]"))
    counted = F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", counted).select(*[F.col(f"`{c}`") for c in docs.columns])


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets replaced by a mark; every document stays."""
    ship_package(spark)
    language, forest = secrets.fit(docs)
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    found = secrets.judge(secrets.find(named, language), forest).filter("is_secret")
    clean = secrets.redact(docs.withColumn("_text", F.col("text")), found)
    changed = F.coalesce(F.col("text") != F.col("_text"), F.lit(False))
    counted = F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", counted).select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, shard by shard, a row for each copy taken."""
    return mixing.mixture(docs)


STAGES = [
    ("language_id", keep_known_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", cut_benchmark_passages),
    ("secret_scans", redact_secrets),
    ("mixing", mix_sources),
]
#: Trained models decide in two of the stages, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
