"""Fingerprints, token alignment and source divergence against plain computations."""

import hashlib
import os
import random
import re
from collections import Counter, defaultdict
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pytest
from compare import connect, spark_rows, sql_rows
from pyspark.sql import functions as F

from tidemark.llm import alignment, divergence, fingerprints, queries
from tidemark.llm.store import table

SF = "/root/testdata/sf0.001"
FOLDER = queries.TOKENIZERS
ODD = [
    "", " ", "one", "two words", "the cat sat on the mat " * 9, "Ünïcode ﬁ ligature — naïve 日本語 text", "tab\tand\nnewline  two  spaces ",
    "literal <s> </s> <0x41> <|endoftext|> ▁ sign", "▁leading", "a\x00b", "🙂🙃 emoji 👩‍👩‍👧 zwj", "x" * 5000, "don't we'll I'VE 123456 1.2.3", " lead", "trail ",
]


def frame(spark, texts, **more):
    rows = [(i, t, "x", "x", "x", "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, links string, sketch string, _row string, tag string").repartition(3)


# Fingerprints


def plain_sketch(text, fraction=1 / 16, least=32):
    words = [w for w in re.split(r"[ \t-\r]+", text or "") if w]
    runs = [words[i : i + 5] for i in range(max(1, len(words) - 4))] if words else []
    hashes = sorted({hashlib.md5(" ".join(r).encode()).hexdigest()[:16] for r in runs})
    return hashes[: max(least, sum(h < format(int(fraction * 16**16), "016x") for h in hashes))]


def plain_likeness(a, b, least=32, end="1" + "0" * 15):
    bound = min(max(end, s[-1] + "0") if len(s) >= least else "g" for s in (a, b))
    x, y = {h for h in a if h < bound}, {h for h in b if h < bound}
    return 1.0 if not a and not b else len(x & y) / len(x) if x else 0.0


def test_fingerprints_equal_the_plain_ones(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = [None, "", *ODD, *(" ".join(rng.choices(words, k=k)) for k in (3, 5, 12, 80, 2000, 30_000))]
    found = fingerprints.edited_likeness(frame(spark, texts)).orderBy("doc_id").collect()
    assert [r.doc_id for r in found] == list(range(len(texts)))
    for i, r in enumerate(found):
        own, after = texts[i] or "", texts[(i + 1) % len(texts)] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        assert r.edited == edited and r.n_chars == len(own)
        assert list(r.sketch) == plain_sketch(own) and list(r.edited_sketch) == plain_sketch(edited)
        assert r.to_edited.containment == plain_likeness(r.sketch, r.edited_sketch)
        assert r.to_next.containment == plain_likeness(r.sketch, plain_sketch(after))


def test_fingerprints_of_edge_rows(spark, edges, nothing):
    assert fingerprints.edited_likeness(nothing).count() == 0
    found = fingerprints.edited_likeness(edges).collect()
    assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in edges.collect())
    alone = fingerprints.edited_likeness(frame(spark, ["only one text of six words"])).first()
    assert alone.to_next.containment == 1.0
    assert alone.edited == "only one text" + "only one text"[: 26 // 2]


def test_likeness_estimates_containment_of_unequal_documents(spark):
    rng = random.Random(1)
    long = [f"t{rng.randrange(10**9)}" for _ in range(20_000)]
    pairs = [(" ".join(long[3000:5000]), " ".join(long)), (" ".join(long), " ".join(long[3000:5000])), (" ".join(long[:9000]), " ".join(long[6000:]))]
    df = spark.createDataFrame(pairs, "a string, b string").select(fingerprints.sketch(F.col("a")).alias("a"), fingerprints.sketch(F.col("b")).alias("b"))
    got = [r.l.containment for r in df.select(fingerprints.likeness(F.col("a"), F.col("b")).alias("l")).collect()]
    assert sorted(abs(g - e) < 0.06 for g, e in zip(sorted(got), sorted((1.0, 0.1, 1 / 3)), strict=True)) == [True] * 3


def test_merged_sketch_is_the_sketch_of_all(spark):
    rng = random.Random(2)
    texts = [" ".join(f"t{rng.randrange(10**6)}" for _ in range(3000)) for _ in range(4)]
    rows = spark.createDataFrame([("g", t) for t in texts], "source string, text string").select("source", fingerprints.sketch(F.col("text")).alias("sketch"))
    merged = sorted(r.hash for r in fingerprints.merge(rows, ["source"]).collect())
    assert merged == sorted({h for t in texts for h in plain_sketch(t) if h < "1" + "0" * 15})


def test_fingerprint_query_has_no_python(spark):
    plan = queries.op11_document_fingerprints(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("name", ["op11_document_fingerprints", "op13_source_divergence"])
def test_query_matches_sql(spark, name):
    assert spark_rows(queries.QUERIES[name](spark, SF)) == sql_rows(connect(SF), queries.SQL[name])


# Alignment


@pytest.fixture(scope="module")
def vocabularies():
    return alignment.Vocabularies.read(f"{FOLDER}/byte_bpe_50k.json", f"{FOLDER}/piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """The tokens of both sides by the libraries that own the files, a document at a time."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(f"{FOLDER}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{FOLDER}/piece_bpe_32k.model")
    letters = alignment._byte_letters()

    def tokens(text):
        one = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        other = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]]
        return one, other

    return tokens


def plain_alignment(texts, tokens):
    out, total = [], Counter()
    for text in texts:
        one, other = tokens(text) if text else ([], [])
        if not text or any(b"".join(t for _, t in side) != b" " + text.encode() for side in (one, other)):
            out.append(([], [], []))
            continue
        ends = []
        for side in (one, other):
            at, last = {}, 0
            for k, (_, t) in enumerate(side):
                last += len(t)
                at[last] = k
            ends.append(at)
        groups, i, j, links = [], 0, 0, []
        for end in sorted(ends[0].keys() & ends[1].keys()):
            x, y = ends[0][end], ends[1][end]
            groups.append(",".join(str(t[0]) for t in one[i : x + 1]) + "|" + ",".join(str(t[0]) for t in other[j : y + 1]))
            links.append((one[x][0], other[y][0]))
            i, j = x + 1, y + 1
        total.update(links)
        out.append((one, other, groups, links))
    best = defaultdict(int)
    for (_, b), n in total.items():
        best[b] = max(best[b], n)
    for one, other, groups, *links in out:
        links = links[0] if links else []
        text = ";".join(groups)
        yield (len(one), len(other), len(groups), len(links), sum(total[p] == best[p[1]] for p in links), sum(total[p] for p in links),
               hashlib.sha256(text.encode()).hexdigest() if groups else "")


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_equals_the_plain_one(spark, vocabularies, plain):
    documents = [r.text for r in table(spark, SF, "documents").orderBy("doc_id").collect()]
    texts = [None, *ODD, *documents, documents[0], "the same words again " * 4000]
    found = alignment.aligned_counts(frame(spark, texts), vocabularies).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in found] == list(plain_alignment(texts, plain))
    assert {"tag", "sketch", "_row"} <= set(found[0].asDict())


def test_alignment_query_equals_the_plain_one(spark, plain):
    found = queries.op12_tokenizer_alignment(spark, SF).orderBy("doc_id").collect()
    texts = [r.text for r in table(spark, SF, "documents").orderBy("doc_id").collect()]
    assert [tuple(r[c] for c in COLUMNS) for r in found] == list(plain_alignment(texts, plain))


def test_alignment_of_edge_rows(spark, edges, nothing, vocabularies):
    assert alignment.aligned_counts(nothing, vocabularies).count() == 0
    found = alignment.aligned_counts(edges, vocabularies).collect()
    assert len(found) == edges.count()
    assert all(r.n_a == 0 and r.groups_sha256 == "" for r in found if r.doc_id == 3)
    assert "node" in found[0].asDict()


def test_groups_as_text(spark, vocabularies):
    row = alignment.align(frame(spark, ["tokenization of unhappiness"]), vocabularies).first()
    assert row.groups.count(";") == row.n_groups - 1 and sum(x.n for x in row.links) == row.n_groups


@pytest.mark.parametrize("work", [1, 2, 3, 7, 64, 10**6])
def test_cuts_are_the_common_ends(work):
    rng = np.random.default_rng(work)
    for n, m in ((0, 0), (0, 5), (1, 1), (40, 3), (300, 280)):
        a, b = (np.sort(rng.choice(600, k, replace=False)) for k in (n, m))
        at_a, at_b = alignment.cuts(a, b, work)
        assert a[at_a].tolist() == b[at_b].tolist() == np.intersect1d(a, b).tolist()
        one, other = alignment.crossings(a, b, work)
        assert (np.diff(one + other) <= work).all() and (one[-1], other[-1]) == (n, m)


def test_byte_vocabulary_encodes_as_its_file_says(vocabularies):
    """Every code point in several surroundings; the library that owns the file is the measure."""
    from tokenizers import Tokenizer

    own, file = alignment.ByteLevel(vocabularies.a), Tokenizer.from_str(vocabularies.a)
    file.encode_special_tokens = True
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][:: 1 if os.environ.get("ALL_POINTS") else 37]
    texts = [f"a{chr(c)}b 1{chr(c)}2 .{chr(c)},  {chr(c)}{chr(c)}" for c in points] + ODD
    wanted = file.encode_batch([" " + t for t in texts], add_special_tokens=False)
    assert all(x.ids == y.tolist() for x, y in zip(wanted, own.encode(texts), strict=True))


def test_pairs_of_ids_are_bounded_by_the_vocabularies(vocabularies):
    """A pair can only be linked if one side's bytes end with the other's: count all such pairs."""
    sides = [set(t for t in c.tokens if t) for c in (alignment.ByteLevel(vocabularies.a), alignment.Pieces(vocabularies.b))]
    possible = sum(t[k:] in sides[1 - s] for s in (0, 1) for t in sides[s] for k in range(len(t)))
    assert possible < sum(len(t) for side in sides for t in side) < 1_000_000


# Divergence


TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def plain_audit(rows, least):
    docs = [(lang or "", source or "", re.findall(TERM, (text or "").translate(str.maketrans(ascii_uppercase, ascii_lowercase))))
            for text, lang, source in rows]
    df, n, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, terms in docs:
        groups[lang].add(source)
        df[lang].update(set(terms))
        n[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, d in df[lang].items() if d >= least]
        counts = {s: [n[lang, s][t] for t in kept] for s in sources}
        counts[None] = [sum(c) for c in zip(*counts.values(), strict=True)]
        p = {s: [1 + 10**9 * (c + 5) // (sum(cs) + 5 * len(kept)) for c in cs] for s, cs in counts.items()}
        for s in sources:
            parts = {
                "pair": [(o, sum(abs(x - y) for x, y in zip(p[s], p[o], strict=True))) for o in sources if o != s],
                "term": [(t, x - q) for t, x, q, c in zip(kept, p[s], p[None], counts[s], strict=True) if c and x > q],
            }
            for part, items in parts.items():
                ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r + 1) for r, (i, v) in enumerate(ordered) if part == "pair" or r < 50]
    return sorted(out)


def made_up(n=400, sources=7):
    rng = random.Random(9)
    words = [f"Wörd{chr(97 + i % 26)}{'x' * (i // 26)}" for i in range(90)]
    pick = lambda: rng.choice([f"s{i}" for i in range(sources)] + ["s0"] * 5 + [None])
    rows = [(" ".join(rng.choices(words[: rng.randrange(5, 90)], k=rng.randrange(0, 60))), rng.choice(["en", "en", "de", None]), pick()) for _ in range(n)]
    return [*rows, (None, "en", "silent"), ("rare word", "fr", "a"), ("", "fr", "b"), (None, None, None), rows[0], rows[0]]


@pytest.mark.parametrize(("shard", "cells"), [(400_000, 1 << 20), (60, 1 << 20), (100, 16)])
def test_divergence_equals_the_plain_one(spark, monkeypatch, shard, cells):
    rows = made_up()
    docs = spark.createDataFrame([(*r, "x", "x") for r in rows], "text string, lang string, source string, place string, n string")
    monkeypatch.setattr(divergence, "SHARD", shard)
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "HELD", shard)
    found = divergence.audit(docs.repartition(4), least=30)
    assert sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in found.collect()) == plain_audit(rows, 30)


def test_divergence_of_edge_rows(spark, edges, nothing):
    assert divergence.audit(nothing).count() == 0
    rows = [(r.text, r.lang, r.source) for r in edges.collect()]
    found = divergence.audit(edges, least=2)
    assert sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in found.collect()) == plain_audit(rows, 2)


def test_shares_are_exact_beyond_64_bits():
    rng = np.random.default_rng(3)
    total = rng.integers(1, 2**50, 1000)
    n = (total * rng.random(1000)).astype(np.int64)
    n[:3] = total[:3]
    got = divergence.shares_of(n, total, 7)
    assert got.tolist() == [1 + 10**9 * (int(a) + 5) // (int(b) + 35) for a, b in zip(n, total, strict=True)]

