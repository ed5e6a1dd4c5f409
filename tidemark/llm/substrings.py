"""Substring dedup: runs of 13 words that an earlier document has, looked up by hash.

The reference is every document with a smaller id.  The index holds the runs of 13 words that
two different texts share, each with the earliest document that has it and its first place
there.  A factor starts at the first indexed run and goes on while the following runs come next
in the same reference; so its words stand in the reference as they stand here.  This is no full
Lempel-Ziv parse: only the earliest document's first place is a reference, so another one may
have a longer passage.  Which words lie in a factor does not depend on that.
Factors are 13 words or longer and may overlap; all words that lie in one are removed.

Only shared runs are indexed.  In every run of 13 words, one of its ten 4-word runs is its
anchor, the one with the lowest hash, so equal runs have equal anchors; anchors are a fifth of
the words.  Documents are dealt into chunks of bounded text.  A chunk sends its distinct
anchors, sorted and packed, to the shards of the hash space; a shard answers which of them
another text has as well.  The chunk then sends the distinct runs with such anchors, each
with its smallest id and place, and gets the smallest of all.  So a passage with a third of
all documents costs one entry for each chunk.  Runs are compared by 64-bit hashes.
Exact copies are found by text beforehand and removed whole.

Edge cases: a null text and one without words have 0 words and keep the empty string.  Fewer
than 13 words are never removed.  Rows of equal id are no reference for each other.  A row
without id comes after all others and is a reference for none.  Ids are integers.  An empty
table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import staged
from tidemark.llm.words import U, Words, grams, lowest, slices, split_words

ANCHOR = 4
#: Text of a chunk, and words of the corpus for each shard of the hash space.
CHUNK_BYTES = 16 << 20
SHARD_WORDS = 8_000_000
_SLOT_BITS = 48
_LAST = np.int64(2**63 - 1)  # stands for a missing id
_REPLY = "chunk int, kind int, shard int, data binary, more binary"


def _packed(values: np.ndarray, rising: bool) -> bytes:
    """64-bit numbers, byte plane by byte plane; of rising ones the differences."""
    if rising:
        values = np.diff(values, prepend=U(0))
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unpacked(data: bytes, rising: bool) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    values = np.ascontiguousarray(planes.T).view(U).ravel()
    return np.cumsum(values, dtype=U) if rising else values


def _bits(flags: np.ndarray) -> bytes:
    return zstandard.compress(np.packbits(flags).tobytes(), 1)


def _flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.decompress(data), np.uint8), count=n).astype(bool)


def _cuts(sorted_values: np.ndarray, bits: int, shards: int) -> np.ndarray:
    """Where each shard's range of a sorted array begins and ends."""
    edges = np.array([(i << bits) // shards for i in range(shards)] + [(1 << bits) - 1], dtype=U)
    cuts = np.searchsorted(sorted_values, edges)
    cuts[-1] = len(sorted_values)
    return cuts


@dataclass
class Chunk:
    """Rows of a chunk, the slots of the anchors of its texts, and those that another text has."""

    table: pa.Table
    ids: np.ndarray
    copy_of: np.ndarray  # the earliest id with the same text, where that is another one
    n: int

    def slices(self):
        """Pieces of the table with their first row."""
        at = 0
        for batch in self.table.combine_chunks().to_batches():
            for part in slices(batch, "text"):
                yield at, part
                at += part.num_rows

    def anchors(self, at: int, part: pa.RecordBatch) -> tuple[Words, np.ndarray, np.ndarray]:
        """Words of a piece, the first words of the runs inside a row, and the slots of their anchors."""
        words = split_words(part.column("text"))
        runs = grams(words.hash, ANCHOR)
        place = lowest(runs, self.n - ANCHOR + 1)
        first = np.flatnonzero(words.inside(self.n)) if len(words.hash) >= self.n else np.zeros(0, np.int64)
        own = self.copy_of[at : at + part.num_rows] == self.ids[at : at + part.num_rows]
        first = first[own[words.row[first]]]  # whole copies need no index
        return words, first, runs[place[first]] >> U(64 - _SLOT_BITS)

    def slots(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct slots, sorted, and whether two different texts of the chunk have them."""
        found, text = [], []
        for at, part in self.slices():
            words, first, slot = self.anchors(at, part)
            new = np.concatenate([[True], (slot[1:] != slot[:-1]) | np.diff(words.row[first]).astype(bool)]) if len(slot) else np.zeros(0, bool)
            found.append(slot[new])
            text.append(np.asarray(part.column("th").cast(pa.int64()))[words.row[first][new]])
        slot, text = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((found, U), (text, np.int64)))
        if not len(slot):
            return slot, np.zeros(0, bool)
        order = np.lexsort((text, slot))
        slot, text = slot[order], text[order]
        start = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        several = np.minimum.reduceat(text, start) != np.maximum.reduceat(text, start)
        return slot[start], several

    def runs(self, shared: np.ndarray):
        """Per piece: its words, the first words of the runs with shared anchors, and their hashes."""
        for at, part in self.slices():
            words, first, slot = self.anchors(at, part)
            place = np.minimum(np.searchsorted(shared, slot), max(0, len(shared) - 1))
            first = first[shared[place] == slot] if len(shared) else first[:0]
            yield at, part, words, first, grams(words.hash, self.n, 41)[first]

    def index(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of those runs, sorted, each with the smallest id of the chunk and its first place there."""
        hashes, ids, places = [np.zeros(0, U)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at, part, words, first, h in self.runs(shared):
            row = words.row[first]
            hashes.append(h)
            ids.append(self.ids[at + row])
            # Rows of equal id are told apart by half their text's hash.
            texts = np.asarray(part.column("th").cast(pa.int64()))[row]
            places.append((texts >> 32 << 32) | (first - words.first[row]))
        return _least(np.concatenate(hashes), np.concatenate(ids), np.concatenate(places))


def _least(keys: np.ndarray, ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((places, ids, keys))
    keys = keys[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[start], ids[order[start]], places[order[start]]


def _chunk(docs: pa.Table, side: pa.Table, n: int) -> tuple[Chunk, dict[tuple[int, int], tuple[bytes, bytes]]]:
    """The chunk, and the answers to it by kind and shard."""
    ids = np.asarray(docs.column("id").fill_null(int(_LAST)).combine_chunks())
    earliest = np.asarray(docs.column("earliest").fill_null(int(_LAST)).combine_chunks())
    rows = side.to_pylist() if side is not None else []
    return Chunk(docs, ids, np.minimum(ids, earliest), n), {(r["kind"], r["shard"]): (r["data"], r["more"]) for r in rows}


def _shared_slots(chunk: Chunk, answers: dict, shards: int) -> np.ndarray:
    slot, _ = chunk.slots()
    cuts = _cuts(slot, _SLOT_BITS, shards)
    keep = np.zeros(len(slot), bool)
    for shard in range(shards):
        if (1, shard) in answers:
            keep[cuts[shard] : cuts[shard + 1]] = _flags(answers[1, shard][0], int(cuts[shard + 1] - cuts[shard]))
    return slot[keep]


def _sent(chunk: int, kind: int, keys: np.ndarray, bits: int, shards: int, more) -> pa.Table:
    cuts = _cuts(keys, bits, shards)
    full = [s for s in range(shards) if cuts[s + 1] > cuts[s]]
    return pa.table({
        "chunk": pa.array([chunk] * len(full), pa.int32()), "kind": pa.array([kind] * len(full), pa.int32()),
        "shard": pa.array(full, pa.int32()), "data": pa.array([_packed(keys[cuts[s] : cuts[s + 1]], True) for s in full], pa.binary()),
        "more": pa.array([more(slice(cuts[s], cuts[s + 1])) for s in full], pa.binary()),
    })


def _answer(group: pa.Table, kind: int, answers: list[bytes]) -> pa.Table:
    return pa.table({
        "chunk": group.column("chunk"), "kind": pa.array([kind] * len(group), pa.int32()), "shard": group.column("shard"),
        "data": pa.array(answers, pa.binary()), "more": pa.array([None] * len(group), pa.binary()),
    })


def _which_are_shared(group: pa.Table) -> pa.Table:
    """A shard's answer to each chunk: which of its slots two different texts have."""
    sent = [_unpacked(d, True) for d in group.column("data").to_pylist()]
    several = [_flags(d, len(s)) for d, s in zip(group.column("more").to_pylist(), sent, strict=True)]
    slots, place, count = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)
    shared = count > 1
    np.logical_or.at(shared, place, np.concatenate(several))
    flags = np.split(shared[place], np.cumsum([len(s) for s in sent])[:-1])
    return _answer(group, 1, [_bits(f) for f in flags])


def _earliest_of_all(group: pa.Table) -> pa.Table:
    """A shard's answer to each chunk: the smallest id that has each of its runs, and its first place there."""
    sent = [_unpacked(d, True) for d in group.column("data").to_pylist()]
    more = [_sources(d) for d in group.column("more").to_pylist()]
    keys, least, places = _least(np.concatenate(sent), *(np.concatenate(x) for x in zip(*more, strict=True)))
    found = [np.searchsorted(keys, s) for s in sent]
    return _answer(group, 2, [_packed_sources(least[f], places[f]) for f in found])


def _packed_sources(ids: np.ndarray, places: np.ndarray) -> bytes:
    return _packed(np.concatenate([ids, places]).view(U), False)


def _sources(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = _unpacked(data, False).view(np.int64)
    return both[: len(both) // 2], both[len(both) // 2 :]


def parse(at: np.ndarray, source: np.ndarray, place: np.ndarray, n: int) -> list[tuple[int, int, int, int]]:
    """Factors ``(first word, words, source, first word there)`` from indexed runs in order, and where their references have them.

    A factor goes on while the next run stands next in the same reference as well.
    """
    if not len(at):
        return []
    start = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(source) != 0) | (np.diff(place) != 1)]))
    end = np.append(start[1:], len(at)) - 1
    return [(int(at[a]), int(at[b] - at[a] + n), int(source[a]), int(place[a] & 0xFFFFFFFF)) for a, b in zip(start, end, strict=True)]


def _cut(chunk: Chunk, shared: np.ndarray, keys: np.ndarray, least: np.ndarray, places: np.ndarray) -> pa.Table:
    """What is left of every row of the chunk."""
    counts, removed, digests, factors = [], [], [], []
    nothing = hashlib.sha256(b"").hexdigest()
    for at, part, words, first, h in chunk.runs(shared):
        found = np.searchsorted(keys, h)
        source, place = (x[found] if len(h) else np.zeros(0, np.int64) for x in (least, places))
        row = words.row[first]
        earlier = source < chunk.ids[at + row]
        first, row, source, place = first[earlier], row[earlier], source[earlier], place[earlier]
        of_row = np.searchsorted(row, np.arange(part.num_rows + 1))
        texts = part.column("text")
        for i in range(part.num_rows):
            a, b = int(words.first[i]), int(words.first[i + 1])
            counts.append(b - a)
            if b - a >= chunk.n and chunk.copy_of[at + i] != chunk.ids[at + i]:
                removed.append(b - a)
                digests.append(nothing)
                factors.append([(0, b - a, int(chunk.copy_of[at + i]), 0)])
                continue
            own = slice(of_row[i], of_row[i + 1])
            found = parse(first[own] - a, source[own], place[own], chunk.n)
            factors.append(found)
            if not found:
                removed.append(0)
                digests.append(hashlib.sha256(b" ".join((texts[i].as_py() or "").encode().split())).hexdigest())
                continue
            gone = np.zeros(b - a, bool)
            for begin, size, _, _ in found:
                gone[begin : begin + size] = True
            removed.append(int(gone.sum()))
            kept = b" ".join(words.data[words.start[j] : words.end[j]].tobytes() for j in a + np.flatnonzero(~gone))
            digests.append(hashlib.sha256(kept).hexdigest())
    shape = pa.list_(pa.struct([("begin", pa.int32()), ("words", pa.int32()), ("source", pa.int64()), ("at", pa.int64())]))
    listed = [[{"begin": b, "words": w, "source": s, "at": p} for b, w, s, p in f] for f in factors]
    return pa.table({
        "id": chunk.table.column("id"), "text_hash": chunk.table.column("th"), "n_words": pa.array(counts, pa.int64()),
        "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string()), "factors": pa.array(listed, shape),
    })


def remove_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 13, chunk_bytes: int = CHUNK_BYTES,
                      shard_words: int = SHARD_WORDS) -> DataFrame:
    """``(key, text_hash, n_words, n_removed, kept_sha256, factors)``, one row for each row of ``docs``.

    A factor is ``(first word, words, source id, first word there)``; a whole copy of an earlier text is one factor.
    """
    docs = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    docs = docs.withColumn("th", F.coalesce(F.xxhash64("text"), F.lit(0)))
    sizes = staged(docs.select("id", "th", F.unhex(F.md5("text")).alias("same"), F.octet_length("text").alias("size")), "sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    chunks, shards = max(1, math.ceil(total / chunk_bytes)), max(1, math.ceil(total / 6 / shard_words))
    dealt = F.pmod(F.xxhash64("id", "th"), F.lit(chunks)).cast("int").alias("chunk")
    # Copies of an earlier text: as few rows as there are copies, sent to their chunks.
    earliest = sizes.filter("same is not null").groupBy("same").agg(F.min("id").alias("earliest"))
    copies = sizes.join(earliest, "same").filter("earliest < id or (id is null and earliest is not null)")
    copies = staged(copies.select(dealt, F.col("id").alias("cid"), F.col("th").alias("cth"), "earliest").distinct(), "copies")
    named = copies.select("chunk", F.lit(0).alias("kind"), F.lit(0).alias("shard"), F.lit(None).cast("binary").alias("data"),
                          F.lit(None).cast("binary").alias("more"), "cid", "cth", "earliest")
    rows = docs.select(dealt, "id", "th", "text")

    def opened(left: pa.Table, right: pa.Table):
        """The chunk with the earliest copies of its rows, and the answers that it got."""
        is_copy = pa.compute.equal(right.column("kind"), 0)
        known = right.filter(is_copy)
        of = dict(zip(zip(known.column("cid").to_pylist(), known.column("cth").to_pylist(), strict=True), known.column("earliest").to_pylist(), strict=True))
        pairs = zip(left.column("id").to_pylist(), left.column("th").to_pylist(), strict=True)
        left = left.append_column("earliest", pa.array([of.get(p) for p in pairs], pa.int64()))
        return _chunk(left, right.filter(pa.compute.invert(is_copy)), n)

    def joined(answers: DataFrame | None, run, schema: str) -> DataFrame:
        """``run`` of every chunk, with what is known about it so far."""
        side = named
        if answers is not None:
            none = [F.lit(None).cast("long").alias(c) for c in ("cid", "cth", "earliest")]
            side = named.unionByName(answers.select("chunk", "kind", "shard", "data", "more", *none))
        side = side.withColumnRenamed("chunk", "to")
        return rows.groupBy("chunk").cogroup(side.groupBy("to")).applyInArrow(run, schema)

    def send_slots(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk, _ = opened(left, right)
        slot, several = chunk.slots()
        number = left.column("chunk")[0].as_py() if len(left) else 0
        return _sent(number, 1, slot, _SLOT_BITS, shards, lambda s: _bits(several[s]))

    def send_runs(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk, answers = opened(left, right)
        keys, ids, places = chunk.index(_shared_slots(chunk, answers, shards))
        number = left.column("chunk")[0].as_py() if len(left) else 0
        return _sent(number, 2, keys, 64, shards, lambda s: _packed_sources(ids[s], places[s]))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk, answers = opened(left, right)
        shared = _shared_slots(chunk, answers, shards)
        keys, _, _ = chunk.index(shared)
        found = [_sources(answers[2, s][0]) for s in range(shards) if (2, s) in answers]
        least, places = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
        return _cut(chunk, shared, keys, least, places)

    slots = staged(joined(None, send_slots, _REPLY), "slots")
    first = staged(slots.groupBy("shard").applyInArrow(_which_are_shared, _REPLY), "answers")
    runs = staged(joined(first, send_runs, _REPLY), "runs")
    second = staged(runs.groupBy("shard").applyInArrow(_earliest_of_all, _REPLY), "answers")
    result = "id bigint, text_hash bigint, n_words bigint, n_removed bigint, kept_sha256 string, " \
             "factors array<struct<begin:int,words:int,source:bigint,at:bigint>>"  # fmt: skip
    return joined(first.unionByName(second), finish, result).withColumnRenamed("id", key)
