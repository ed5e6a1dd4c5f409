"""Benchmark decontamination: a broadcast set of test n-grams, verified hits, spans removed.

Words are maximal runs of ASCII letters, digits and non-ASCII characters, A to Z folded to
lower case.  A window is ten consecutive words of a benchmark item; an item of fewer words
is one window.  Documents are scanned once for each block of the benchmark: a block has
a bounded number of words, so what is broadcast is bounded however large the benchmark is.
A word run is looked up by hash in the block's sorted hashes and then compared byte by byte.

Edge cases: null texts and texts without words have no words and no hits; items without
words have no windows.  Repeated rows are judged alike.  Equal item ids count once.  An
empty benchmark hits nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.store import staged
from tidemark.llm.words import ALNUM, Words, grams, slices, split_words

#: Words of the benchmark in one broadcast block.
BLOCK_WORDS = 2_000_000


@dataclass
class Block:
    """Distinct windows of some items, by length: sorted hashes, their words, the items they occur in."""

    lengths: dict[int, tuple[np.ndarray, list[bytes], list[list[int]]]]
    items: list[str | None]


def _window_bytes(words: Words, at: int, n: int) -> bytes:
    return b" ".join(words.data[words.start[i] : words.end[i]].tobytes() for i in range(at, at + n))


def build_block(items: list[tuple[str, str]], n: int) -> Block:
    words = split_words(pa.array([text for _, text in items], pa.string()), ALNUM, lower=True)
    count = np.diff(words.first)
    found: dict[int, dict[bytes, list[int]]] = {}
    hashes: dict[int, dict[bytes, int]] = {}
    for item, (first, length) in enumerate(zip(words.first[:-1], count, strict=True)):
        size = min(n, int(length))
        if not size:
            continue
        own = grams(words.hash[first : first + length], size)
        for at in range(len(own)):
            key = _window_bytes(words, first + at, size)
            owners = found.setdefault(size, {}).setdefault(key, [])
            if not owners or owners[-1] != item:
                owners.append(item)
            hashes.setdefault(size, {})[key] = int(own[at])
    lengths = {}
    for size, keys in found.items():
        order = sorted(keys, key=lambda k: (hashes[size][k], k))
        lengths[size] = (np.array([hashes[size][k] for k in order], np.uint64), order, [keys[k] for k in order])
    return Block(lengths, [item for item, _ in items])


def hits(words: Words, block: Block) -> list[tuple[int, int, list[int]]]:
    """``(first word, length, items)`` of every occurrence of a window of the block."""
    out = []
    for size, (hashes, keys, owners) in block.lengths.items():
        own = grams(words.hash, size)
        if not len(own):
            continue
        own, at = own[inside := words.inside(size)], np.flatnonzero(inside)
        place = np.searchsorted(hashes, own)
        near = np.flatnonzero(hashes[np.minimum(place, len(hashes) - 1)] == own)
        for i in near:
            text = None
            for j in range(int(place[i]), len(hashes)):
                if hashes[j] != own[i]:
                    break
                text = text or _window_bytes(words, at[i], size)
                if keys[j] == text:
                    out.append((int(at[i]), size, owners[j]))
    return out


def benchmark_blocks(benchmark: DataFrame, n: int, item: str = "item_id", text: str = "text", limit: int = BLOCK_WORDS):
    """The benchmark in blocks of about ``limit`` words, one at a time."""
    rows, size = [], 0
    for name, body in benchmark.select(F.col(item).cast("string"), text).filter(F.col(text).isNotNull()).toLocalIterator():
        rows.append((name, body))
        size += len(body) // 2 + 1
        if size >= limit:
            yield build_block(rows, n)
            rows, size = [], 0
    if rows:
        yield build_block(rows, n)


def _scan(column: pa.Array, block: Block) -> pa.Array:
    """Per row: number of words, hit words as ranges ``[from, to)``, items."""
    shape = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.list_(pa.int32()))), ("items", pa.list_(pa.string()))])
    out = []
    for part in slices(pa.record_batch([column], names=["text"]), "text"):
        words = split_words(part.column(0), ALNUM, lower=True)
        found: dict[int, list] = {}
        for at, size, owners in hits(words, block):
            found.setdefault(int(words.row[at]), []).append((at - int(words.first[words.row[at]]), size, owners))
        for row, n_words in enumerate(np.diff(words.first).tolist()):
            own = sorted(found.get(row, []), key=lambda x: x[:2])
            items = {block.items[i] for _, _, owners in own for i in owners if block.items[i] is not None}
            out.append({"n_words": n_words, "runs": _merged([[a, a + s] for a, s, _ in own]), "items": sorted(items)})
    return pa.array(out, shape)


def _merged(runs: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for begin, end in sorted(runs):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


SCAN = "struct<n_words:bigint,runs:array<array<int>>,items:array<string>>"


def find(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text",
         block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_runs`` (word ranges) and ``hit_items`` (sorted).

    A benchmark of one block takes one pass; each further block is a pass over the written
    result of the one before, so that no task holds two blocks.
    """
    names = [c for c in docs.columns if c not in ("n_words", "hit_runs", "hit_items")]
    out = docs.select(*[F.col(f"`{c}`") for c in names])
    blocks, number = benchmark_blocks(benchmark, n, text=text, limit=block_words), 0
    for number, block in enumerate(blocks, 1):
        out = _with_hits(spark, staged(out, "decontaminate") if number > 1 else out, block, names, text, number > 1)
    return out if number else _with_hits(spark, out, build_block([], n), names, text, False)


def _with_hits(spark: SparkSession, docs: DataFrame, block: Block, names: list[str], text: str, more: bool) -> DataFrame:
    shared = spark.sparkContext.broadcast(block)

    @F.arrow_udf(SCAN)
    def scan(column: pa.Array) -> pa.Array:
        return _scan(column, shared.value)

    docs = docs.withColumn("_scan", scan(F.col(text)))
    runs, items = F.col("_scan.runs"), F.col("_scan.items")
    if more:
        runs, items = F.concat("hit_runs", runs), F.array_sort(F.array_union("hit_items", items))
    return docs.select(*[F.col(f"`{c}`") for c in names], F.col("_scan.n_words").alias("n_words"), runs.alias("hit_runs"), items.alias("hit_items"))


def hit_words(runs):
    """Column expression: how many words the ranges cover together."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        F.array_sort(runs), start,
        lambda acc, r: F.struct(
            F.greatest(acc["end"], r[1]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), r[1] - F.greatest(acc["end"], r[0]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )


def cut(text: str, block: Block) -> str:
    """``text`` without the words of any window, until none occurs; its other characters stay."""
    while True:
        words = split_words(pa.array([text], pa.string()), ALNUM, lower=True)
        runs = _merged([[at, at + size] for at, size, _ in hits(words, block)])
        if not runs:
            return text
        raw, kept, done = text.encode(), [], 0
        for begin, end in runs:
            kept.append(raw[done : words.start[begin]])
            done = words.end[end - 1]
        text = b"".join([*kept, raw[done:]]).decode()


def remove(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text",
           block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with the benchmark's windows cut out of the text; texts without hits stay as they are."""
    for number, block in enumerate(benchmark_blocks(benchmark, n, text=text, limit=block_words), 1):
        clean = _cutter(spark.sparkContext.broadcast(block))
        docs = staged(docs, "decontaminate") if number > 1 else docs
        docs = docs.withColumn(text, clean(F.col(text)))
    return docs


def _cutter(shared):
    @F.arrow_udf("string")
    def clean(column: pa.Array) -> pa.Array:
        out = []
        for part in slices(pa.record_batch([column], names=["text"]), "text"):
            words = split_words(part.column(0), ALNUM, lower=True)
            dirty = {int(words.row[at]) for at, _, _ in hits(words, shared.value)}
            out += [cut(t, shared.value) if i in dirty else t for i, t in enumerate(part.column(0).to_pylist())]
        return pa.array(out, pa.string())

    return clean


def items_digest(items):
    """Column expression: SHA-256 of the sorted items, comma-joined."""
    return F.sha2(F.concat_ws(",", items), 256)
