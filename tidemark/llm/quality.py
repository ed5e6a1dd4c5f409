"""Quality: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model (``kneser``) is over words, three at a time, and its tables grow with the corpus.  Words are
runs without white space.  A word that no trusted text has is spelled, byte by byte.  The probabilities
of all words after a context, with what is kept for unknown ones, sum to one.

A document is kept if its perplexity is not above a quantile of its language's trusted texts
that the model hasn't seen.  Short texts vary more: the quantile is taken in spreads that depend
on the length, as those texts show it.

Edge cases: null and empty texts have no perplexity and are not kept.  A null language is a
language of its own; one without unseen trusted texts uses the quantiles of all.  Without any
trusted text, or any unseen one, all other texts are kept.  Repeated rows are judged alike;
other columns are kept, result columns replace columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.kneser import log_probabilities
from tidemark.llm.store import staged


def perplexity(spark: SparkSession, docs: DataFrame, trusted: DataFrame, text: str = "text", key: str | None = None) -> DataFrame:
    """``docs`` with ``perplexity`` per character, under the model of the texts ``trusted``, and ``n_chars``.

    With ``key``, ``trusted`` names documents by that column and needs no text; their texts are read once and not shuffled.
    """
    body = F.col(f"`{text}`")

    def texts(table: DataFrame, learned: bool) -> DataFrame:
        own = F.col(f"`{key}`").cast("long") if key else F.lit(None).cast("long")
        return table.filter(F.length(body) > 0).select(own.alias("id"), F.lit(learned).alias("learned"), F.xxhash64(body).alias("h"), body.alias("text"))

    if key:
        sums = log_probabilities(spark, texts(docs, False), trusted.select(F.col(f"`{key}`").cast("long").alias("id")))
    else:
        sums = log_probabilities(spark, texts(docs, False).unionAll(texts(trusted, True)))
    names = [c for c in docs.columns if c not in ("perplexity", "n_chars", "_logp", "_h", "_size")]
    out = docs.select(*[F.col(f"`{c}`") for c in names], F.length(body).alias("n_chars"), F.xxhash64(body).alias("_own"))
    out = out.join(sums.toDF("_h", "_logp", "_size"), F.col("_own") == F.col("_h"), "left")
    measured = F.when(F.col("n_chars") > 0, F.exp(-F.col("_logp") / (F.col("_size") + 1)))
    return out.select(*[F.col(f"`{c}`") for c in names], "n_chars", measured.alias("perplexity"))


def judge(scored: DataFrame, unseen: DataFrame, key: str = "doc_id", size: str = "n_chars", lang: str = "lang",
          high: float = 0.99) -> DataFrame:
    """``scored`` with ``highest`` and ``kept``: by the quantile ``high`` over the ids ``unseen`` of trusted texts.

    A text of n characters differs from its language's median by a spread of
    ``sqrt(a + b / n)``, fitted to the unseen texts above it; the quantile is that of the differences in
    spreads.  A language with fewer unseen texts than a quantile needs uses those of all.
    """
    u, x = 1 / F.greatest(F.col(size), F.lit(1)), F.log("perplexity")
    reference = scored.filter(F.col("perplexity").isNotNull()).join(unseen.select(F.col(key)).distinct(), key, "left_semi")
    reference = staged(reference.select(F.col(lang).alias("l"), x.alias("x"), u.alias("u")), "reference")
    centres = reference.groupBy("l").agg(F.percentile_approx("x", F.lit(0.5), F.lit(10000)).alias("centre"), F.count(F.lit(1)).alias("many"))
    centres = centres.select(F.col("l").alias("cl"), "centre", F.col("many") >= math.ceil(1 / (1 - high) - 1e-9))
    centres = centres.toDF("cl", "centre", "enough")
    around = reference.join(centres, F.col("l").eqNullSafe(F.col("cl"))).withColumn("d", F.col("x") - F.col("centre"))
    # Only what lies above the centre: below it are copies of what the model has learned.
    square, above = F.when(F.col("d") >= 0, F.col("d") * F.col("d")), F.when(F.col("d") >= 0, F.col("u"))
    fitted = [F.greatest(F.lit(0.0), F.regr_slope(square, above)).alias("b"), F.avg(square).alias("s"), F.avg(above).alias("m")]
    quantile = F.percentile_approx(F.col("d") / _spread(F.col("u")), F.lit(high), F.lit(10000)).alias("q")
    of_all = around.agg(*fitted).first().asDict()
    shared = around.withColumns({c: F.lit(v).cast("double") for c, v in of_all.items()})
    of_all |= {"q": shared.agg(quantile).first()["q"], "centre": reference.agg(F.percentile_approx("x", F.lit(0.5), F.lit(10000))).first()[0]}
    own = around.filter("enough").groupBy("l").agg(*fitted).withColumnRenamed("l", "fl")
    quantiles = around.join(own, F.col("l").eqNullSafe(F.col("fl"))).groupBy("fl", "b", "s", "m").agg(quantile)
    of_lang = centres.join(quantiles, F.col("cl").eqNullSafe(F.col("fl")), "left").select("cl", "centre", "b", "s", "m", "q")
    of_lang = staged(of_lang.toDF(*[f"_{c}" for c in of_lang.columns]), "bounds")
    joined = scored.join(of_lang, scored[lang].eqNullSafe(of_lang["_cl"]), "left")
    joined = joined.withColumns({f"_{c}": F.coalesce(F.col(f"_{c}"), F.lit(v).cast("double")) for c, v in of_all.items()})
    bound = F.col("_centre") + F.col("_q") * _spread(u, "_")
    kept = F.when(F.col("perplexity").isNull(), False).otherwise(F.coalesce(x <= bound + 1e-9, F.lit(True)))
    names = [F.col(f"`{c}`") for c in scored.columns if c not in ("highest", "kept")]
    return joined.select(*names, F.exp(bound).alias("highest"), kept.alias("kept"))


def _spread(u, prefix: str = ""):
    """The spread of texts of ``1 / u`` characters, from the slope ``b`` and the means ``s`` and ``m`` of squares and ``u``."""
    b, s, m = (F.col(prefix + c) for c in "bsm")
    b = F.coalesce(b, F.lit(0.0))
    return F.sqrt(F.greatest(F.lit(1e-12), s - b * m) + b * u)
