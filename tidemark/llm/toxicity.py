"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Texts are lower-cased, letters that look like Latin ones and digits or signs that stand for
letters are folded, and words are joined by single spaces.  The lexicon has whole words and
word beginnings with weights, learned as log odds from labelled texts, and exception phrases: a
match inside one doesn't count.  The score is a logistic function of the summed weights
and of their share of the text's length, also fitted on the labelled sample.

An entry must be more frequent in toxic texts than chance explains, and occur between several
different neighbours: words that only copies of one toxic text share are left out.

Edge cases: null and empty texts have no match and get the lowest score.  Rows without label or
without text aren't learned from; without labels of both kinds the lexicon is empty and all
scores are the share of toxic labels.  Repeated rows are scored alike, other columns are kept;
result columns replace columns of the same name.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import smallest_by_hash, staged

# Look-alikes of Latin letters (Cyrillic, Greek, others), and signs that stand for letters.
HOMOGLYPHS = str.maketrans({
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ѐ": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ⅰ": "i", "ꜱ": "s", "ᴏ": "o", "​": "", "‌": "", "‍": "", "⁠": "",
    "﻿": "", "­": "", **{chr(0xFF41 + i): chr(97 + i) for i in range(26)},
})
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"})
_WORD = re.compile(r"[^\W_]+(?:[@$!][^\W_]+)*")
_PREFIXES = range(3, 11)
#: Evidence that an entry is more than chance, in nats; least log odds; least number of different neighbours.
EVIDENCE, ODDS, NEIGHBOURS = 12.0, 2.0, 3


def fold(text: str) -> list[str]:
    words = _WORD.findall(text.lower().translate(HOMOGLYPHS))
    return [w if w.isalpha() or w.isdigit() else w.translate(SIGNS) for w in words]


@dataclass
class Lexicon:
    """Entries are `` word `` or `` beginning``, with the space before it; weights in nats."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def matcher(self):
        automaton = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            automaton.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            automaton.add_word(phrase, (len(phrase), None))
        if len(automaton):
            automaton.make_automaton()
        return automaton

    def score(self, sums: np.ndarray, words: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        return 1 / (1 + np.exp(-(a + b * np.log1p(sums) + c * np.log1p(1000 * sums / (words + 50)))))


def matches(automaton, words: list[str]) -> list[tuple[int, int, float]]:
    """``(begin, end, weight)`` in the joined words, the longest of overlapping ones, without those inside an exception."""
    if not len(automaton) or not words:
        return []
    found, quiet = [], []
    for last, (size, weight) in automaton.iter(f" {' '.join(words)} "):
        (quiet if weight is None else found).append((last + 1 - size, last + 1, weight or 0.0))
    out: list[tuple[int, int, float]] = []
    quiet.sort()
    at = spared = 0  # exceptions that begin so far, and where the farthest of them ends
    for begin, end, weight in sorted(found, key=lambda x: (x[0], -x[1])):
        while at < len(quiet) and quiet[at][0] <= begin:
            spared = max(spared, quiet[at][1])
            at += 1
        if end <= spared or out and begin < out[-1][1] - 1:
            continue
        out.append((begin, end, weight))
    return out


def _entries(word: str) -> list[str]:
    return [f" {word[:n]}" for n in _PREFIXES if n < len(word)] + [f" {word} "]


def _count(batches):
    """Per batch: in how many toxic and other texts each entry occurs, and some neighbours of it in toxic ones."""
    for batch in batches:
        toxic, other, near = Counter(), Counter(), defaultdict(set)
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            words = ["", *fold(text), ""]
            (toxic if label else other).update({e for w in set(words[1:-1]) for e in _entries(w)})
            if label:
                for before, word, after in zip(words, words[1:], words[2:], strict=False):
                    place = zlib.crc32(f"{before} {after}".encode())
                    for entry in _entries(word):
                        if len(near[entry]) < 2 * NEIGHBOURS:
                            near[entry].add(place)
        names = sorted(toxic.keys() | other.keys())
        yield pa.record_batch(
            [pa.array(names), pa.array([toxic[e] for e in names]), pa.array([other[e] for e in names]), pa.array([sorted(near[e]) for e in names], pa.list_(pa.int64()))],
            names=["entry", "toxic", "other", "near"],
        )


def _evidence(toxic: int, other: int, share: float) -> float:
    q = toxic / (toxic + other)
    return (toxic + other) * (q * math.log(q / share) + ((1 - q) * math.log((1 - q) / (1 - share)) if q < 1 else 0.0))


def choose_entries(counted: dict[str, tuple[int, int]], n_toxic: int, n_other: int) -> dict[str, float]:
    """The shortest beginnings that are toxic enough, each made longer as long as it keeps what it finds."""
    share = n_toxic / (n_toxic + n_other)
    odds = {e: math.log((t + 0.5) / (n_toxic + 1)) - math.log((o + 0.5) / (n_other + 1)) for e, (t, o) in counted.items()}
    good = [e for e, (t, o) in counted.items() if odds[e] >= ODDS and t / (t + o) > share and _evidence(t, o, share) >= EVIDENCE]
    longer = defaultdict(list)
    for entry in counted:
        for n in _PREFIXES:
            if len(entry.rstrip()) - 1 >= n and entry != entry[: n + 1]:
                longer[entry[: n + 1]].append(entry)
    chosen: dict[str, float] = {}
    for entry in sorted(good, key=lambda e: (len(e), e)):
        if any(entry.startswith(c) for c in chosen):
            continue
        while True:
            toxic, other = counted[entry]
            better = [e for e in longer[entry] if counted[e][0] >= 0.98 * toxic or counted[e][0] >= 0.85 * toxic and counted[e][1] < 0.3 * other]
            if not better:
                break
            entry = max(better, key=lambda e: (odds[e], -len(e), e))
        chosen[entry] = odds[entry]
    return {e: w for e, w in chosen.items() if not any(e != c and e.startswith(c) for c in chosen)}


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        per_class: int = 3000, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """Learn from at most ``per_class`` labelled texts of each kind."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(label).cast("int").alias("label"))
    picked = [smallest_by_hash(known.filter(F.col("label") == kind).distinct(), per_class, "k", seed=3) for kind in (0, 1)]
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).filter("text is not null")
    # At most 2 * per_class short rows are broadcast.
    sample = texts.join(F.broadcast(picked[0].union(picked[1])), "k")
    # Copies with both labels count as most of them do, as toxic if that is half.
    sample = staged(sample.groupBy("text").agg((F.avg("label") >= 0.5).cast("int").alias("label")), "labelled")
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n_other, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_other or not n_toxic:
        share = (n_toxic + 0.5) / (n_toxic + n_other + 1) if n_toxic + n_other else 0.05
        return Lexicon(curve=(math.log(share / (1 - share)), 0.0, 0.0))
    counted = (
        sample.mapInArrow(_count, "entry string, toxic bigint, other bigint, near array<bigint>")
        .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"), F.size(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near"))
        .filter((F.col("near") >= NEIGHBOURS) & (F.col("toxic") * (n_other + 1) >= math.exp(ODDS) / 3 * F.col("other") * (n_toxic + 1)))
        # With fewer toxic texts there can't be evidence enough, even without any other text.
        .filter(F.col("toxic") * math.log((n_toxic + n_other) / n_toxic) >= EVIDENCE)
    )
    entries = choose_entries({r["entry"]: (r["toxic"], r["other"]) for r in sorted(counted.collect(), key=lambda r: (-r["toxic"], r["entry"]))}, n_toxic, n_other)
    lexicon = Lexicon(entries, [f" {' '.join(fold(p))} " for p in exceptions])
    seen = sample.mapInArrow(lambda batches: _measure(batches, lexicon), "label int, words double, total double, hit array<string>")
    lexicon.exceptions += _harmless(seen)
    kept = sample.mapInArrow(lambda batches: _measure(batches, lexicon), "label int, words double, total double, hit array<string>")
    lexicon.curve = _curve(np.array(sorted(tuple(r) for r in kept.select("label", "words", "total").collect()), np.float64))
    return lexicon


def _measure(batches, lexicon: Lexicon):
    """Per text: label, number of words, summed weights, and the matched words with their neighbours."""
    automaton = lexicon.matcher()
    for batch in batches:
        rows = []
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            words = fold(text)
            joined, found = f" {' '.join(words)} ", matches(automaton, words)
            hits = set()
            for begin, _, _ in found:
                end = joined.index(" ", begin + 1)
                after = joined.find(" ", end + 1)
                hits |= {joined[begin : end + 1], joined[begin : after + 1] if after > 0 else "", joined[joined.rfind(" ", 0, max(begin, 1)) if begin else 0 : end + 1]}
            rows.append({"label": label, "words": float(len(words)), "total": sum(w for _, _, w in found), "hit": sorted({h for h in hits if h})})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
            [("label", pa.int32()), ("words", pa.float64()), ("total", pa.float64()), ("hit", pa.list_(pa.string()))]))


def _harmless(seen: DataFrame) -> list[str]:
    """Matched words and phrases that occur in several other texts and in no toxic one."""
    hits = seen.select("label", F.explode("hit").alias("hit")).groupBy("hit").agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("texts"))
    return sorted(r["hit"] for r in hits.filter("toxic = 0 and texts >= 3").collect())


def _curve(rows: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, with a ridge that keeps separable samples finite."""
    label, words, total = rows.T
    x = np.stack([np.ones(len(rows)), np.log1p(total), np.log1p(1000 * total / (words + 50))], axis=1)
    w = np.zeros(3)
    ridge = np.diag([0.01, 0.2, 0.2])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (label - p) - ridge @ w
        w += np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, gradient)
    return tuple(float(v) for v in w)


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) and ``toxic_terms``, the number of matches."""

    @F.arrow_udf("struct<score:double,terms:int>")
    def judge(column: pa.Array) -> pa.Array:
        automaton = lexicon.matcher()
        sums, sizes, terms = [], [], []
        for body in column:
            words = fold(body.as_py() or "")
            found = matches(automaton, words)
            sums.append(sum(w for _, _, w in found))
            sizes.append(len(words))
            terms.append(len(found))
        scores = lexicon.score(np.array(sums, np.float64), np.array(sizes, np.float64))
        return pa.StructArray.from_arrays([pa.array(scores), pa.array(terms, pa.int32())], ["score", "terms"])

    docs = docs.drop("toxicity", "toxic_terms", "_judged")
    judged = docs.withColumn("_judged", judge(F.col(text)))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return judged.select(*kept, F.col("_judged.score").alias("toxicity"), F.col("_judged.terms").alias("toxic_terms"))
