"""Near-duplicate, substring and decontamination operators against brute force."""

import hashlib
import math
import pathlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm.conftest import DOCUMENT, EDGES, rows
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, embeddings, graph, neardup, substrings
from tidemark.llm.darts import shingles, signatures
from tidemark.llm.words import ALNUM, U, grams, lowest, split_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def made_documents(n, seed, size=60):
    """Documents with copies, near copies and shared passages."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out, passage = [], rng.choices(vocabulary, k=20)
    for i in range(n):
        kind = rng.random()
        text = rng.choices(vocabulary, k=rng.randint(1, size))
        if out and kind < 0.5:
            text = list(rng.choice(out))
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                if text:
                    text[rng.randrange(len(text))] = rng.choice(vocabulary)
        elif kind < 0.7:
            text[rng.randint(0, len(text)) : 0] = passage
        out.append(text)
    return rows(*[(i, " ".join(t), "en", "s") for i, t in enumerate(out)])


def jaccard_sets(text, n=5):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute_classes(documents, least=0.8):
    sets = [jaccard_sets(d[1]) for d in documents]
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and shared >= least * (len(a) + len(sets[j]) - shared) and root[i] != root[j]:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    ids = {}
    for i, r in enumerate(root):
        known = [d[0] for d, x in zip(documents, root, strict=True) if x == r and d[0] is not None]
        ids[i] = min(known) if known else None
    return ids


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("chunk_items", [200_000, 60])
def test_classes_match_brute_force(spark, monkeypatch, seed, chunk_items):
    documents = made_documents(150, seed)
    monkeypatch.setattr(neardup.links_of, "__defaults__", (chunk_items,))
    got = neardup.near_duplicates(spark.createDataFrame(documents, DOCUMENT)).collect()
    want = brute_classes(documents)
    assert {r["doc_id"]: r["class_id"] for r in got} == {d[0]: want[i] for i, d in enumerate(documents)}
    assert sum(r["kept"] for r in got) == len(set(want.values()))


def test_class_edges(spark, edges, nothing):
    got = neardup.near_duplicates(edges).collect()
    assert len(got) == len(EDGES)
    copies = [r for r in got if r["class_id"] == 1]
    assert len(copies) == 5 and sum(r["kept"] for r in copies) == 1 and {r["class_size"] for r in copies} == {5}  # 116 of 134 runs
    assert all(r["kept"] and r["class_id"] == r["doc_id"] for r in got if r["class_id"] != 1)
    assert neardup.near_duplicates(nothing).count() == 0


def test_signatures_estimate_weighted_jaccard():
    a = np.arange(100, dtype=U) * U(7919) + U(3)
    b = np.concatenate([a[:80], a[:20] + U(1)])
    row = np.repeat([0, 1], 100)
    kept = signatures(row, np.concatenate([a, b]), 2, 4000)
    assert abs((kept[0] == kept[1]).mean() - 80 / 120) < 0.04
    half = signatures(np.repeat([0, 1], 100), np.concatenate([a, a]), 2, 4000, excess=np.repeat([1.0, 0.5], 100))
    assert abs((half[0] == half[1]).mean() - 0.5) < 0.04
    row, item = shingles(split_words(pa.array(["x x x x x x x"])), 1, 5, counted=True)
    assert len(set(item.tolist())) == 3


def test_components(spark):
    rng = random.Random(4)
    pairs = [(f"n{rng.randrange(60):02d}", f"n{rng.randrange(60):02d}") for _ in range(45)] + [(f"p{i:02d}", f"p{i + 1:02d}") for i in range(30)]
    root = {x: x for p in pairs for x in p}
    for _ in root:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(pairs, "a string, b string")).collect()}
    assert got == {x: r for x, r in root.items() if any(x in p and p[0] != p[1] for p in pairs)}


@pytest.mark.parametrize("shape", ["path", "ordered path", "star", "chain of cliques"])
def test_components_take_logarithmic_steps(spark, monkeypatch, shape):
    rng, n = random.Random(8), 700
    name = list(range(n))
    if shape != "ordered path":
        rng.shuffle(name)
    pairs = {
        "star": [(0, i) for i in range(1, n)],
        "chain of cliques": [(i + x, i + y) for i in range(0, n - 7, 7) for x in range(8) for y in range(x)],
    }.get(shape, [(i, i + 1) for i in range(n - 1)])
    steps, write = [], graph.staged
    monkeypatch.setattr(graph, "staged", lambda df, label: steps.append(label) or write(df, label))
    found = graph.components(spark.createDataFrame([(name[a], name[b]) for a, b in pairs], "a long, b long"))
    nodes = {name[x] for p in pairs for x in p}
    assert {r["label"] for r in found.collect()} == {min(nodes)} and found.count() == len(nodes)
    assert steps.count("offers") <= 3 * math.log2(n)


def brute_cut(documents, n=13):
    first, out = {}, {}
    for i, text in sorted((d[0], d[1]) for d in documents):
        w = words(text)
        gone = [False] * len(w)
        for j in range(len(w) - n + 1):
            if first.setdefault(tuple(w[j : j + n]), i) < i:
                gone[j : j + n] = [True] * n
        out[i] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest())
    return out


@pytest.mark.parametrize("chunk_bytes,shard_words", [(1 << 24, 8_000_000), (2000, 300)])
def test_cut_matches_brute_force(spark, chunk_bytes, shard_words):
    documents = made_documents(200, 5, 120)
    got = substrings.remove_duplicates(spark.createDataFrame(documents, DOCUMENT), chunk_bytes=chunk_bytes, shard_words=shard_words).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == brute_cut(documents)
    assert all(f["words"] >= 13 and f["source"] < r["doc_id"] for r in got for f in r["factors"])


def test_cut_edges(spark, edges, nothing):
    got = substrings.remove_duplicates(edges).collect()
    assert len(got) == len(EDGES)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    empty = hashlib.sha256(b"").hexdigest()
    assert by_id[1]["n_removed"] == 0 and by_id[2]["n_removed"] == by_id[2]["n_words"] == 120 and by_id[2]["kept_sha256"] == empty
    assert [r["n_removed"] for r in got if r["doc_id"] == 2] == [120, 120]
    assert (by_id[3]["n_words"], by_id[5]["n_words"], by_id[10]["n_removed"]) == (0, 0, 0)
    assert sorted(r["n_removed"] for r in got if r["doc_id"] is None) == [0, 120]
    assert by_id[9]["n_removed"] == 138 and [(f["begin"], f["words"], f["source"]) for f in by_id[9]["factors"]] == [(0, 18, 8), (18, 120, 1)]
    assert substrings.remove_duplicates(nothing).count() == 0


def brute_hits(documents, items, n=10):
    fold = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    windows = {}
    for item, text in items:
        w = fold(text)
        size = min(n, len(w))
        for j in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[j : j + size]), set()).add(item)
    out = {}
    for d in documents:
        w, hit, found = fold(d[1]), set(), set()
        for size in {len(k) for k in windows}:
            for j in range(len(w) - size + 1):
                if owners := windows.get(tuple(w[j : j + size])):
                    hit.update(range(j, j + size))
                    found |= owners
        out[d[0]] = (len(w), len(hit), sorted(found))
    return out


@pytest.mark.parametrize("block_words", [2_000_000, 12])
def test_hits_match_brute_force(spark, block_words):
    documents = made_documents(80, 6)
    picked = [d[1].split() for d in documents[::9]]
    items = [(str(i), " ".join(w[:15]).upper() if i % 2 else " ".join(w[:4])) for i, w in enumerate(picked)] + [("n", None), ("e", ""), ("!", "?! ...")]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    docs = spark.createDataFrame(documents, DOCUMENT)
    got = decontaminate.find(spark, docs, benchmark, block_words=block_words).withColumn("n", decontaminate.hit_words(F.col("hit_runs")))
    want = brute_hits(documents, items)
    assert {r["doc_id"]: (r["n_words"], r["n"], r["hit_items"]) for r in got.collect()} == want
    left = decontaminate.remove(spark, docs, benchmark)
    assert decontaminate.find(spark, left, benchmark).filter(F.size("hit_runs") > 0).count() == 0
    same = {r["doc_id"]: r["text"] for r in left.collect()}
    assert all(same[d[0]] == d[1] for d in documents if not want[d[0]][1])


def test_hit_edges(spark, edges, nothing):
    benchmark = spark.createDataFrame([(1, EDGES[0][1]), (1, "one"), (None, "one")], "item_id int, text string")
    got = decontaminate.find(spark, edges, benchmark).collect()
    assert len(got) == len(EDGES) and all(r["n_words"] == 0 for r in got if r["text"] in (None, ""))
    assert [r["hit_items"] for r in got if r["doc_id"] == 6] == [["1"]]
    none = decontaminate.find(spark, edges, benchmark.limit(0)).collect()
    assert not any(r["hit_runs"] for r in none) and decontaminate.find(spark, nothing, benchmark).count() == 0


def test_grams_and_lowest():
    h = split_words(pa.array(["a b a b a b a b a b a b a", "b a b a"]), ALNUM).hash
    assert len(set(grams(h, 3)[:11].tolist())) == 2
    values = np.array([3, 1, 1, 5, 0, 2])
    assert lowest(values, 3).tolist() == [1, 1, 4, 4]


def test_embedding_links_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "INTERVAL", 64)
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.RandomState(3)
    centres = rng.normal(size=(25, 8))
    x = (centres[rng.randint(0, 25, 300)] + rng.normal(scale=0.25, size=(300, 8))).astype(np.float32)
    x[50:60] = x[50]
    vectors = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [None] * 8), (904, [1.0, 2.0]), (None, x[50].tolist()), (905, [])]
    table = spark.createDataFrame(vectors + odd, "vec_id bigint, embedding array<float>").withColumn("node", F.lit("x"))
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(table).collect()}
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    label = np.arange(300)
    for _ in range(300):
        label = np.array([label[near[i]].min() for i in range(300)])
    assert [got[i]["n_links"] for i in range(300)] == (near.sum(axis=1) - 1).tolist()
    assert [got[i]["component_id"] for i in range(300)] == label.tolist()
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(900, 906))
    assert got[None]["n_links"] == 0 and embeddings.near_duplicates(table.limit(0)).count() == 0


def _linked(x, least=0.9):
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    near, label = unit @ unit.T >= least, np.arange(len(x))
    while True:
        lower = np.array([label[near[i]].min() for i in range(len(x))])
        if (lower == label).all():
            return near.sum(axis=1) - 1, label
        label = lower


def test_embedding_rounds_match_brute_force(spark, monkeypatch):
    # Twenty intervals in ten rounds, whose links are summed up after each.
    monkeypatch.setattr(embeddings, "INTERVAL", 20)
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    monkeypatch.setattr(embeddings, "ROUND_BYTES", 2 * 20 * 8 * 4)
    monkeypatch.setattr(embeddings, "KEPT", 0)
    rng = np.random.RandomState(4)
    x = (rng.normal(size=(30, 8))[rng.randint(0, 30, 400)] + rng.normal(scale=0.25, size=(400, 8))).astype(np.float32)
    x[200:320] = x[200] + rng.normal(scale=0.02, size=(120, 8))
    x[330:350] = x[330]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(table).collect()}
    links, label = _linked(x)
    assert [got[i]["n_links"] for i in range(400)] == links.tolist()
    assert [got[i]["component_id"] for i in range(400)] == label.tolist()


def test_embedding_disk_does_not_grow_with_pairs_of_intervals(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "INTERVAL", 50)
    plans, own = [], embeddings.staged

    def written(df, label):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return own(df, label)

    monkeypatch.setattr(embeddings, "staged", written)
    folder = pathlib.Path(spark.conf.get("spark.checkpoint.dir"), "tidemark")
    before = set(folder.glob("*"))
    rng = np.random.RandomState(5)
    x = rng.normal(size=(600, 64))
    for i in range(0, 300, 3):  # cosines close to the limit, on both sides of it
        across = x[i + 1] - x[i] * (x[i + 1] @ x[i]) / (x[i] @ x[i])
        cosine = 0.9 + rng.choice([-1, 1]) * 10.0 ** -rng.randint(2, 7)
        x[i + 1] = cosine * x[i] / np.linalg.norm(x[i]) + (1 - cosine**2) ** 0.5 * across / np.linalg.norm(across)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(table).collect()}
    links, label = _linked(x)
    assert [got[i]["n_links"] for i in range(600)] == links.tolist() and 20 < links.sum() / 2 < 80
    assert [got[i]["component_id"] for i in range(600)] == label.tolist()
    # Intervals aren't dealt out by pairs, and no copy of the vectors stays.
    compared = [plan for label, plan in plans if label == "links"]
    assert compared and not any("Exchange" in plan for plan in compared)
    kept = sum(f.stat().st_size for d in set(folder.glob("*")) - before for f in d.rglob("*.parquet"))
    assert kept < x.nbytes / 4


def test_factors_stand_in_their_source(spark):
    rng = random.Random(21)
    lines = [" ".join(f"w{rng.randrange(1000)}" for _ in range(20)) for _ in range(8)]
    texts = {i: " ".join(rng.choices(lines, k=12)) for i in range(12)}
    got = substrings.remove_duplicates(spark.createDataFrame(rows(*[(i, t, "en", "s") for i, t in texts.items()]), DOCUMENT), chunk_bytes=2000).collect()
    words = {i: t.split() for i, t in texts.items()}
    factors = [(r["doc_id"], f) for r in got for f in r["factors"]]
    assert factors and all(words[i][f["begin"] : f["begin"] + f["words"]] == words[f["source"]][f["at"] : f["at"] + f["words"]] for i, f in factors)
    assert all(sum(any(f["begin"] <= p < f["begin"] + f["words"] for f in r["factors"]) for p in range(240)) == r["n_removed"] for r in got)
