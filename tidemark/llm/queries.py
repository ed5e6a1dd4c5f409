"""The operators on the provided tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment, decontaminate, divergence, embeddings, fingerprints, html_text, langid, mixing, neardup, quality, secrets,
    substrings, toxicity,
)
from tidemark.llm.store import calibration, held_out, staged, table, training_fold

#: SQL with the same rows, for DuckDB.
SQL: dict[str, str] = {
    "op2_substring_dedup": r"""
        WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
        runs AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
        first AS (SELECT g, min(doc_id) AS source FROM runs GROUP BY g),
        gone AS (SELECT DISTINCT doc_id, i + j AS p FROM runs JOIN first USING (g), range(13) AS r(j) WHERE source < doc_id),
        word AS (SELECT doc_id, i AS p, w[i] AS x FROM d, unnest(range(1, len(w) + 1)) AS t(i)),
        kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op4_embedding_near_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
        reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, n.b FROM reach r JOIN near n ON r.b = n.a)
        SELECT vec_id, (SELECT count(*) FROM near WHERE a = vec_id) AS n_links, component_id, component_id = vec_id AS kept
        FROM v JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = vec_id""",
    "op8_benchmark_decontamination": r"""
        WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        sized AS (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
        test AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM sized, unnest(range(1, len(w) - n + 2)) AS t(i)),
        sizes AS (SELECT DISTINCT n FROM sized),
        runs AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
        hit AS (SELECT doc_id, n, i, item FROM runs JOIN test USING (n, g)),
        words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS t FROM (SELECT DISTINCT doc_id, item FROM hit)
                  GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(t, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_document_fingerprints": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        n AS (SELECT doc_id, t, coalesce(lead(t) OVER o, first_value(t) OVER o) AS u FROM d WINDOW o AS (ORDER BY doc_id NULLS FIRST)),
        e AS (SELECT doc_id, t, u, t[1:length(t) - length(t) // 2] || u[1:length(t) // 2] AS e FROM n),
        w AS (SELECT doc_id, k, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS w
              FROM (SELECT doc_id, unnest(['own', 'edited', 'next']) AS k, unnest([t, e, u]) AS x FROM e)),
        h AS (SELECT doc_id, k, list_sort(list_distinct([left(md5(array_to_string(w[i:i + 4], ' ')), 16)
                     FOR i IN range(1, if(len(w) = 0, 1, greatest(len(w) - 3, 2)))])) AS h FROM w),
        s AS (SELECT doc_id, k, h[1:greatest(32, len(list_filter(h, lambda x: x < '1000000000000000')))] AS s FROM h),
        l AS (SELECT doc_id, k, s, if(len(s) >= 32, greatest('1000000000000000', s[-1] || '0'), 'g') AS l FROM s),
        p AS (SELECT a.doc_id, b.k, a.s AS own, b.s AS s, list_filter(a.s, lambda x: x < least(a.l, b.l)) AS a,
                     list_filter(b.s, lambda x: x < least(a.l, b.l)) AS b FROM l a JOIN l b USING (doc_id) WHERE a.k = 'own' AND b.k <> 'own'),
        c AS (SELECT doc_id, k, own, s, len(a) AS a, len(b) AS b, len(list_intersect(a, b)) AS i FROM p),
        near AS (SELECT doc_id, k, own, s, CASE WHEN len(own) = 0 AND len(s) = 0 THEN 1.0::DOUBLE WHEN a = 0 THEN 0.0 ELSE i / a END AS containment,
                        CASE WHEN len(own) = 0 AND len(s) = 0 THEN 1.0::DOUBLE WHEN a + b - i = 0 THEN 0.0 ELSE i / (a + b - i) END AS jaccard FROM c)
        SELECT doc_id, length(t) AS n_chars, sha256(e) AS edited_sha256, array_to_string(x.own, '') AS fingerprint,
               array_to_string(x.s, '') AS edited_fingerprint, x.containment AS near_edited, y.containment AS near_next,
               x.jaccard AS jaccard_edited, y.jaccard AS jaccard_next
        FROM e JOIN near x USING (doc_id) JOIN near y USING (doc_id) WHERE x.k = 'edited' AND y.k = 'next'""",
    "op13_source_divergence": r"""
        WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        kept AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 30),
        c AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d) SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        g AS (SELECT DISTINCT lang, source FROM d),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        a AS (SELECT lang, source, term, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total, v
              FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
        p AS (SELECT lang, source, term, n, (1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v))::BIGINT AS p FROM a),
        l AS (SELECT lang, term, sum(n) AS n FROM a GROUP BY ALL),
        q AS (SELECT lang, term, (1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v))::BIGINT AS q FROM l JOIN v USING (lang)),
        pair AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
                 FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
        parts AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0)::BIGINT AS value
                  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
                  LEFT JOIN pair ON pair.lang = x.lang AND pair.source = x.source AND pair.item = y.source
                  UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
        ranked AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM parts)
        SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50""",
}

#: Folder of the public vocabularies that op12 aligns.
TOKENIZERS = "/opt/tokenizers"


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    language, forest = secrets.fit(docs)
    found = secrets.judge(secrets.find(docs, language), forest)
    return found.select(
        "doc_id", "begin", "end", "rule", F.sha2("value", 256).alias("value_sha256"), F.round("probability", 6).alias("probability"), "is_secret"
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_duplicates(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.words_of(F.col("text")).alias("n"))
    docs = staged(docs, "sizes")
    mixed = mixing.mix(docs, F.col("n"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.col("draws.shard").alias("shards"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    trusted = table(spark, sf_dir, "labels").filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
    learned = trusted.filter(training_fold() & ~calibration())
    scored = staged(quality.perplexity(spark, docs, learned, key="doc_id").select("doc_id", "lang", "perplexity", "n_chars"), "scored")
    judged = quality.judge(scored, trusted.filter(calibration()), size="n_chars")
    return judged.select("doc_id", "perplexity", "highest", "kept")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    trees = html_text.train(html_text.derived_pages(pages))
    return html_text.extract(pages.select("page_id", "url", "html"), trees).select("page_id", "url", "text", "n_chars")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(training_fold()))
    return toxicity.score(docs, lexicon).select(
        "doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.3).cast("int").alias("predicted"), "toxic_terms",
    )


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(spark, docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", decontaminate.hit_words(F.col("hit_runs")).alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"), decontaminate.items_digest(F.col("hit_items")).alias("items_sha256"),
        (F.size("hit_runs") > 0).alias("contaminated"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(training_fold()))
    judged = langid.identify(docs.select("doc_id", "text"), model)
    return judged.select(
        "doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
        F.size("lang_spans").alias("n_spans"),
    )


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "kept")


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.edited_likeness(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprints.fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprints.fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"), F.col("to_edited.containment").alias("near_edited"),
        F.col("to_next.containment").alias("near_next"), F.col("to_edited.jaccard").alias("jaccard_edited"),
        F.col("to_next.jaccard").alias("jaccard_next"),
    )


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str, folder: str = TOKENIZERS) -> DataFrame:
    vocabularies = alignment.Vocabularies.read(f"{folder}/byte_bpe_50k.json", f"{folder}/piece_bpe_32k.model")
    found = alignment.aligned_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabularies)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


QUERIES = {
    "op1_secret_scans": op1_secret_scans,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_mixing": op3_mixing,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_html_extraction": op6_html_extraction,
    "op7_toxicity": op7_toxicity,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op9_language_id": op9_language_id,
    "op11_document_fingerprints": op11_document_fingerprints,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_source_divergence": op13_source_divergence,
}
