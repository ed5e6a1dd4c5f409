"""The pipeline stage by stage, and the queries' contracts on the smallest tables."""

import pytest
from compare import connect, spark_rows, sql_rows
from llm.conftest import DOCUMENT, EDGES, rows
from llm.test_near_duplicates import brute_classes, brute_cut, brute_hits
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import mixing
from tidemark.llm.queries import QUERIES, SQL
from tidemark.llm.store import staged

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stages(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name == "secret_scans":  # the smallest table has none
            told = F.concat("text", F.lit(' token = "9c1185a5c5e9fc54612808977ee8f548b2258d31" ends'))
            docs = staged(docs.withColumn("text", F.when(F.col("doc_id") % 40 == 0, told).otherwise(F.col("text"))), "told")
        out = staged(stage(spark, docs, SF), name)
        assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        before = {r["doc_id"]: r for r in docs.collect()}
        after = {r["doc_id"]: r for r in out.collect()}
        assert set(after) <= set(before)
        gone = set(before) - set(after)
        if name == "language_id":
            assert all(not any(c.isalpha() for c in before[i]["text"]) for i in gone)
        if name == "near_dedup":
            order = sorted(before)
            classes = brute_classes([before[i] for i in order] and [(i, before[i]["text"]) for i in order])
            assert set(after) == {order[i] for i, c in classes.items() if c == order[i]}
        if name == "decontamination":
            items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            hit = brute_hits([(i, r["text"]) for i, r in before.items()], items)
            assert {i for i in after if after[i]["text"] != before[i]["text"]} | gone == {i for i, h in hit.items() if h[1]}
            assert not any(h[1] for h in brute_hits([(i, r["text"]) for i, r in after.items()], items).values())
        if name == "secret_scans":
            assert not gone and {i for i, r in after.items() if r["text"] != before[i]["text"]} == {i for i in before if i % 40 == 0}
            assert all(after[i]["text"].endswith(' token = "<SECRET>" ends') for i in after if i % 40 == 0)
        docs = out
    copies = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    taken = copies.agg(F.sum("words")).first()[0]
    assert abs(taken - docs.agg(F.sum(mixing.words_of(F.col("text")))).first()[0]) <= 20


def test_stages_take_odd_rows(spark, documents):
    edges = spark.createDataFrame(EDGES + rows(*[(1000 + i, r["text"], r["lang"], r["source"]) for i, r in enumerate(documents.limit(40).collect())]), DOCUMENT)
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, edges, SF).count() > 0
        assert stage(spark, edges.limit(0), SF).count() == 0
    assert corpus_pipeline.keep_known_language(spark, edges.limit(0), SF).count() == 0


def test_op2_is_the_contract(spark, documents):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in QUERIES["op2_substring_dedup"](spark, SF).collect()}
    assert got == brute_cut([(r["doc_id"], r["text"]) for r in documents.collect()])


def test_op8_is_the_contract(spark, documents):
    import hashlib

    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute_hits([(r["doc_id"], r["text"]) for r in documents.collect()], items)
    for r in QUERIES["op8_benchmark_decontamination"](spark, SF).collect():
        n, hit, found = want[r["doc_id"]]
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (n, hit, len(found), digest, hit > 0)


def test_op7_and_op9_on_held_out_rows(spark, documents):
    toxic = QUERIES["op7_toxicity"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    held = toxic.filter("held_out").select("toxic", "predicted").collect()
    assert sum(r["toxic"] == r["predicted"] for r in held) >= 0.9 * len(held)
    lang = QUERIES["op9_language_id"](spark, SF).join(documents.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in lang) >= 0.97 * len(lang)


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SF)) == sql_rows(connect(SF), SQL[name])
