"""Interpolated modified Kneser-Ney over word trigrams, by questions and answers between packs of texts and shards of the n-grams.

A task packs its texts: the distinct words as they are spelled, and every text as numbers of
them.  A pack holds a bounded number of words (a longer text is a pack of its own).  All later
steps read the packs, which lie in Spark's buckets, so that only questions and answers move.

*Trigrams.*  A pack sends each distinct trigram of its texts once, with the count it has in the
pack's trusted texts, to the shard of its hash: sorted, as differences, byte plane by byte plane.
The shard answers with the count in all trusted text, and names one pack the owner.
*Pairs.*  From the trigrams it owns a pack knows its part of what a pair needs: how often it is a
context, with how many followers of count 1, 2 and more, and how many words come before it.  The
shards add these up in the same way.  *Words.*  From the pairs it owns, likewise.
*Spelling.*  A word that no trusted text has is spelled: an equal model over the bytes of the
distinct trusted words, three at a time; that table has at most 2^24 rows and is collected.
With the answers a pack computes the probability of each of its words, and sums them by text.

So a key with a third of all words costs one entry for each pack.  The hash space is worked off in
parts (``ROUNDS``) one after another, and what was asked is removed before the next part, which bounds the disk.
N-grams are known by 56 bits of a hash, words by 64.
"""

from __future__ import annotations

import math
import uuid
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.store import discard, staged
from tidemark.llm.words import NOT_SPACE, U, Words, hashes, mix, slices, split_words, text_bytes
from tidemark.session import new_run_dir
from tidemark.sources import folders

#: Words of a pack, and words of the corpus for each shard of the hash space.
PACK_WORDS, SHARD_WORDS = 1_500_000, 2_000_000
KEY_BITS = 56
_MARKS = np.array([0x5354415254, 0x454E44], U)  # what stands before a text, twice, and after it
_CHARS = NOT_SPACE & (np.arange(256) & 0xC0 != 0x80)  # bytes that begin a character
_PAD, _STOP = 0xFF, 0x20  # before and after a spelled word
TRUSTED, WORD, PAIR, TRIGRAM = 0, 1, 2, 3
#: In how many parts, one after another, the hash space is worked off, and the packs are scored.
ROUNDS, SCORE_ROUNDS = {WORD: 1, PAIR: 3, TRIGRAM: 3}, 2

_PACK = "pack bigint, ids array<bigint>, of array<int>, learned array<boolean>, texts array<bigint>, sizes array<int>, tokens binary, words binary, chars array<int>"
_QUESTION = "pack bigint, shard int, keys binary, parts binary"
_ANSWER = "pack bigint, level int, shard int, data binary, own binary, places array<int>, tally array<bigint>"


def _packed(values: np.ndarray, grouped: bool = False) -> bytes:
    """Numbers from 0 on, byte plane by byte plane, of as many bytes as the largest needs; the first byte says how many.

    ``grouped``: in a plane the bytes of small numbers come before those of larger ones, which compresses better where small ones are frequent.
    """
    values = values.reshape(-1)
    values = values.astype(np.min_scalar_type(int(values.max(initial=0))), copy=False)
    width = values.dtype.itemsize
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T)
    if grouped := grouped and width > 1:
        for i in range(width - 1):
            planes[i] = planes[i, _by_size(values >> 8 * (i + 1))]
    return bytes([width | grouped << 7]) + zstandard.compress(planes.tobytes(), 1)


def _unpacked(data: bytes, dtype=None) -> np.ndarray:
    """The numbers; without ``dtype``, of the bytes they were packed with."""
    width = data[0] & 0x7F
    planes = np.frombuffer(zstandard.decompress(memoryview(data)[1:]), np.uint8).reshape(width, -1)
    if data[0] >> 7:
        out = planes[-1].astype(f"u{width}")
        for plane in planes[-2::-1]:
            low = np.empty(len(out), np.uint8)
            low[_by_size(out)] = plane
            out = out << 8 | low
    else:
        out = np.ascontiguousarray(planes.T).view(f"u{width}").ravel()
    return out if dtype is None else out.astype(dtype, copy=False)


def _by_size(high: np.ndarray) -> np.ndarray | slice:
    """Places of small, middle and large numbers, by their higher bytes."""
    if not high.any():
        return slice(None)
    return np.concatenate([np.flatnonzero(own) for own in (high == 0, (high > 0) & (high < 16), high >= 16)])


def _packs(batches, limit: int):
    """The texts ``(id, learned, h, text)`` of a task in packs; a pack has a text once."""
    task, number = TaskContext.get().partitionId(), 0
    pack = _Filling()
    for batch in batches:
        for part in slices(batch, "text"):
            pack.add(part)
            if pack.size >= limit:
                yield pack.row(task << 32 | number)
                pack, number = _Filling(), number + 1
    if pack.ids:
        yield pack.row(task << 32 | number)


class _Filling:
    """A pack that is being filled."""

    def __init__(self) -> None:
        self.size, self.ids, self.of, self.learned, self.sizes, self.chars = 0, [], [], [], [], []
        self.place: dict[int, int] = {}
        self.seen, self.tokens, self.known, self.spelled = 0, [], [], []

    def add(self, part: pa.RecordBatch) -> None:
        new = []
        for h in part.column("h").to_pylist():
            new.append(h not in self.place)
            self.of.append(self.place.setdefault(h, len(self.place)))
        self.ids += part.column("id").to_pylist()
        self.learned += part.column("learned").to_pylist()
        texts = part.column("text").filter(pa.array(new, pa.bool_()))
        words = split_words(texts)
        self.chars += np.diff(np.append(0, np.cumsum(_CHARS[words.data]))[text_bytes(texts)[1]]).tolist()
        self.sizes += np.diff(words.first).tolist()
        found, at, which = _distinct(words.hash)
        self.tokens.append(which + self.seen)
        self.known.append(found)
        self.seen += len(found)
        self.spelled.append(_spelled(words, at))
        self.size += len(words.hash) + len(new)

    def row(self, number: int) -> pa.RecordBatch:
        _, at, place = _distinct(np.concatenate(self.known))
        tokens = place[np.concatenate(self.tokens)]
        # The most frequent words have the smallest numbers, which compress best; equally frequent ones are numbered as they come.
        count, begin = np.bincount(tokens, minlength=len(at)), np.empty(len(at), np.int64)
        begin[tokens[::-1]] = np.arange(len(tokens))[::-1]
        order = np.argsort((count.max(initial=0) - count) * len(tokens) + begin)
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        # So the words that come once are numbered on from the first of them, and all are stored as that one.
        tokens, words = np.minimum(rank[tokens], np.uint32((count > 1).sum())), pa.concat_arrays(self.spelled).take(pa.array(at[order]))
        spelled = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), b"\n")[0].as_py()
        values = [number, self.ids, self.of, self.learned, list(self.place), self.sizes, _packed(tokens, grouped=True), zstandard.compress(spelled, 6), self.chars]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.int32()),
                 pa.binary(), pa.binary(), pa.list_(pa.int32())]
        return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=[c.split()[0] for c in _PACK.split(", ")])


def _spelled(words: Words, at: np.ndarray) -> pa.Array:
    """The bytes of some of the words."""
    length = (words.end - words.start)[at]
    offsets = np.concatenate([[0], np.cumsum(length)])
    data = words.data[np.repeat(words.start[at] - offsets[:-1], length) + np.arange(offsets[-1])]
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def _lines(data: bytes) -> Words:
    """The words of lines of one word each."""
    data = np.frombuffer(data, np.uint8)
    end = np.append(np.flatnonzero(data == 10), len(data))[: len(data)]  # no data: no word
    start = np.append(0, end[:-1] + 1)[: len(end)]
    return Words(data, start, end, np.zeros(len(end), np.int64), np.array([0, len(end)]), hashes(data, start, end))


class Pack:
    """A pack with the answers it has so far."""

    def __init__(self, row: dict, answers: list[dict], shards: int) -> None:
        self.row, self.shards = row, shards
        self.answers = {(a["level"], a["shard"]): a for a in answers}
        self.spelling = _lines(zstandard.decompress(row["words"]))
        self.words = np.concatenate([self.spelling.hash, _MARKS])
        self.kinds = len(self.words)

    @cached_property
    def by_hash(self) -> np.ndarray:
        return np.argsort(self.words, kind="stable")

    def numbers(self) -> np.ndarray:
        """The words of all texts in a row, those that come once counted on from the first of them."""
        out = _unpacked(self.row["tokens"], np.int64)
        top = int(out.max(initial=0))
        once = np.flatnonzero(out == top)
        if top + len(once) == self.kinds - 2:
            out[once] += np.arange(len(once))
        return out

    def learned(self) -> np.ndarray:
        """How many trusted documents have each text."""
        flags = np.array([bool(x) for x in self.row["learned"]], bool)
        if (TRUSTED, 0) in self.answers:
            flags[self.answers[TRUSTED, 0]["places"]] = True
        return np.bincount(np.array(self.row["of"], np.int64)[flags], minlength=len(self.row["sizes"]))

    def sequence(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words and marks of all texts in a row; the places that are predicted, and the text of each."""
        sizes = np.array(self.row["sizes"], np.int64)
        end = np.cumsum(sizes + 3) - 1  # place of the mark after each text
        out = np.full(int((sizes + 3).sum()), self.kinds - 2, np.int64)
        inner = np.ones(len(out), bool)
        inner[end - sizes - 2] = inner[end - sizes - 1] = False
        at = np.flatnonzero(inner)
        inner[end] = False
        out[inner], out[end] = self.numbers(), self.kinds - 1
        return out, at, np.repeat(np.arange(len(sizes)), sizes + 1)

    def keys(self, sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the pair and of the trigram that begin at each place."""
        begun, n = mix(self.words, 1), max(1, len(sequence) - 1)
        pairs, trigrams = np.empty(n - 1 + (len(sequence) > 1), U), np.empty(n - 1, U)
        for i, j in _blocks(len(pairs)):
            part = sequence[i : j + 2]
            word = self.words[part]
            pair = mix(begun[part[:-1]] + word[1:], 2)
            pairs[i:j] = pair[: j - i]
            trigrams[i:j] = mix(pair[:-1] + word[2:], 3)[: j - i]
        return pairs, trigrams

    def answer(self, level: int, keys: np.ndarray, parts: int, column: str = "data") -> np.ndarray:
        """The sums for each of the rising ``keys``, a row for each part."""
        found = [np.zeros((parts, 0), np.int64)]
        for shard in np.flatnonzero(np.diff(_dealt(keys, self.shards))).tolist():
            found.append(_unpacked(self.answers[level, shard][column], np.int64).reshape(parts, -1))
        found = np.concatenate(found, 1)
        if parts > 1:
            found[0] += found[1] + 2 * found[2]
        return found

    def owned(self, level: int, keys: np.ndarray, trusted: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count of each key that the pack owns, and a place of each, out of the ``trusted`` keys at the places ``at``."""
        keys = _rising(keys)
        cuts, owned, counts = _dealt(keys, self.shards), [keys[:0]], [np.zeros(0, np.int64)]
        for shard in np.flatnonzero(np.diff(cuts)).tolist():
            count = _unpacked(self.answers[level, shard]["own"])
            own = np.flatnonzero(count)
            owned.append(keys[own + cuts[shard]])
            counts.append(count[own].astype(np.int64))
        rising, order, first = _ordered(trusted)
        return np.concatenate(counts), at[order[first[np.searchsorted(rising[first], np.concatenate(owned))]]]

    def ask(self, keys: np.ndarray, parts: list[np.ndarray], part_of: tuple[int, int]) -> pa.Table:
        """Questions about the rising ``keys`` to the shards of a part of the hash space."""
        cuts = _dealt(keys, self.shards)
        small, rows = keys >> U(64 - KEY_BITS), []
        for shard in (part_of[0] + np.flatnonzero(np.diff(cuts[part_of[0] : part_of[1] + 1]))).tolist():
            own = slice(cuts[shard], cuts[shard + 1])
            values = np.stack([p[own] for p in parts]).astype(np.int64)
            rows.append((self.row["pack"], shard, _packed(np.diff(small[own], prepend=U(0))), _packed(values)))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["pack", "shard", "keys", "parts"])

    def within(self, keys: np.ndarray, part_of: tuple[int, int]) -> np.ndarray:
        """Which keys belong to a part of the hash space."""
        edges = _edges(self.shards)
        return (keys >= edges[part_of[0]]) & ((keys < edges[part_of[1]]) if part_of[1] < self.shards else True)

    def ask_trigrams(self, part_of: tuple[int, int]) -> pa.Table:
        """Only the trigrams of the part are sorted."""
        sequence, at, text = self.sequence()
        keys = self.keys(sequence)[1][at - 2]
        own = self.within(keys, part_of)
        keys, order, first = _ordered(keys[own])
        counts = np.add.reduceat(self.learned()[text[own]][order], first) if len(first) else first
        return self.ask(keys[first], [counts], part_of)

    def ask_pairs(self, part_of: tuple[int, int]) -> pa.Table:
        """The pairs of the part; they are counted from the trigrams that the pack owns."""
        sequence, at, text = self.sequence()
        of_place, keys = self.keys(sequence)
        keys, trusted = keys[at - 2], self.learned()[text] > 0
        count, place = self.owned(TRIGRAM, keys, keys[trusted], at[trusted])
        pairs = _rising(of_place[self.within(of_place, part_of)])
        context, ending = of_place[place - 2], of_place[place - 1]
        own = self.within(context, part_of)
        ending = np.searchsorted(pairs, np.sort(ending[self.within(ending, part_of)]))
        return self.ask(pairs, _of_contexts(count[own], np.searchsorted(pairs, context[own]), ending, len(pairs)), part_of)

    def ask_words(self, part_of: tuple[int, int]) -> pa.Table:
        sequence, at, text = self.sequence()
        keys, trusted = self.keys(sequence)[0], at[self.learned()[text] > 0] - 1
        before, place = self.owned(PAIR, keys, keys[trusted], trusted)
        parts = _of_contexts(before, sequence[place], sequence[place + 1], self.kinds)
        return self.ask(self.words[self.by_hash], [p[self.by_hash] for p in parts], part_of)

    def answer_words(self, parts: int = 5, column: str = "data") -> np.ndarray:
        """The answers on words, in the order of ``words``."""
        found = self.answer(WORD, self.words[self.by_hash], parts, column)
        back = np.empty_like(self.by_hash)
        back[self.by_hash] = np.arange(self.kinds)
        return found[:, back]

    def spellings(self) -> pa.Table:
        """Byte trigrams of the trusted words that the pack owns."""
        (own,) = self.answer_words(1, "own")
        keys, _ = _byte_grams(self.spelling, np.flatnonzero(own[:-2] > 0))
        keys, n = np.unique(keys, return_counts=True)
        return pa.table({"key": pa.array(keys, pa.int64()), "n": pa.array(n, pa.int64())})

    def scores(self, tallies: dict[int, list[int]], spelled: Spelling) -> pa.Table:
        """Log probability of each text, and its characters that are no white space."""
        sequence, at, text = self.sequence()
        pairs, trigrams = self.keys(sequence)
        keys, _, pair = _distinct(pairs)
        of_pair, of_word = self.answer(PAIR, keys, 5), self.answer_words()
        # The answers on trigrams, back from the order of their hashes to their places.
        keys, order, first = _ordered(trigrams[at - 2])
        count = np.zeros(len(sequence), np.int64)
        count[at[order]] = np.repeat(self.answer(TRIGRAM, keys[first], 1)[0], np.diff(first, append=len(at)))
        cuts = {level: discounts(*tallies[level][:4]) for level in (WORD, PAIR, TRIGRAM)}
        one, two, _, _, kinds, total = tallies[WORD]
        everywhere = np.array([total, one, two, kinds - one - two])[:, None]
        below = np.zeros(self.kinds)
        unknown = np.flatnonzero(of_word[4][:-2] == 0)
        grams, word = _byte_grams(self.spelling, unknown)
        some = np.zeros(1 << 24, bool)
        some[grams] = True
        distinct, number = np.flatnonzero(some), np.empty(1 << 24, np.int32)  # only the pages of grams that occur are touched
        number[distinct] = np.arange(len(distinct), dtype=np.int32)
        below[unknown] = np.bincount(word, spelled(distinct)[number[grams]], len(unknown))
        below = _interpolated(of_word[4], np.broadcast_to(everywhere, (4, self.kinds)), cuts[WORD], below, mixed=False)
        of_word, of_pair, logp = np.ascontiguousarray(of_word[:4].T), np.ascontiguousarray(of_pair.T), np.zeros(len(sequence))
        for i, j in _blocks(len(trigrams)):  # the trigrams that begin at these places
            context = of_pair.take(pair[i : j + 1], axis=0).T
            lower = _interpolated(context[4], of_word.take(sequence[i : j + 1], axis=0).T, cuts[PAIR], below[sequence[i + 1 : j + 2]])
            logp[i + 2 : j + 2] = _interpolated(count[i + 2 : j + 2], context[:4, :-1], cuts[TRIGRAM], lower[1:])
        logp = logp[at]
        sums = np.bincount(text, logp, len(self.row["sizes"]))
        return pa.table({"h": pa.array(self.row["texts"], pa.int64()), "logp": pa.array(sums, pa.float64()), "chars": pa.array(self.row["chars"], pa.int32())})


def _blocks(n: int, size: int = 1 << 14):
    """Where stretches of ``n`` places begin and end whose temporary arrays fit a core's cache."""
    return ((i, min(n, i + size)) for i in range(0, n, size))


def _edges(shards: int) -> np.ndarray:
    """The lowest key of each shard."""
    return np.array([(i << KEY_BITS) // shards for i in range(shards)], U) << U(64 - KEY_BITS)


def _dealt(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's stretch of rising keys begins and ends."""
    return np.append(np.searchsorted(keys, _edges(shards)), len(keys))


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Places of rising keys that differ from the one before."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


def _rising(keys: np.ndarray) -> np.ndarray:
    """The distinct keys, rising."""
    ordered = np.sort(keys)
    return ordered[_firsts(ordered)]


def _ordered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys, rising; the place each comes from; and where each distinct one begins."""
    order = np.argsort(keys)
    ordered = keys[order]
    return ordered, order, _firsts(ordered)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, rising; a place of each; and which of them every place has."""
    ordered, order, first = _ordered(keys)
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(keys)))
    return ordered[first], order[first], rank


def _of_contexts(count: np.ndarray, context: np.ndarray, ending: np.ndarray, n: int) -> list[np.ndarray]:
    """For each shorter n-gram: the sum over what follows it, how many followers have count 1, 2 and more, how many words come before it."""
    kinds = [np.bincount(context[own], minlength=n) for own in (count == 1, count == 2, count > 2)]
    return [np.bincount(context, count, n), *kinds, np.bincount(ending, minlength=n)]


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Discounts of counts 1, 2 and more, from how many n-grams occur once to four times; fixed ones where a count has none."""
    if not (n1 and n2 and n3 and n4):
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    return [min(max(i - (i + 1) * y * b / a, 0.05), i - 0.05) for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]


def _interpolated(count: np.ndarray, of_context: np.ndarray, cut: list[float], lower: np.ndarray, mixed: bool = True) -> np.ndarray:
    """Log probabilities from counts, their contexts ``(total, followers of count 1, 2, more)`` and the lower order; ``mixed``: counted ones get of it too.

    After a context that trusted text lacks, the lower order stands.
    """
    total = np.maximum(of_context[0], 1)
    rest = np.maximum(sum(c * n for c, n in zip(cut, of_context[1:4], strict=True)) / total, 1e-300)
    out, seen = np.log(rest) + lower, np.flatnonzero(count > 0)
    kept = (count[seen] - np.array([0.0, *cut])[np.minimum(count[seen], 3)]) / total[seen]
    out[seen] = np.log(np.maximum(kept + (rest[seen] * np.exp(lower[seen]) if mixed else 0.0), 1e-300))
    return np.where(of_context[0] == 0, lower, out)


def _byte_grams(spelling, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Three bytes for each byte of the chosen words and for the stop after them; and the place of its word among the chosen."""
    length = (spelling.end - spelling.start)[chosen]
    word = np.repeat(np.arange(len(chosen)), length + 1)
    place = np.arange(len(word)) - np.repeat(np.cumsum(length + 1) - length - 1, length + 1)
    padded = np.append(spelling.data, 0).astype(np.int64)
    begin = np.repeat(spelling.start[chosen], length + 1)
    byte = lambda back: np.where(place < back, _PAD, padded[np.maximum(begin + place - back, 0)])
    last = np.where(place == np.repeat(length, length + 1), _STOP, padded[begin + place])
    return byte(2) << 16 | byte(1) << 8 | last, word


class Spelling:
    """The model over bytes, from counts of three bytes."""

    def __init__(self, keys: np.ndarray, n: np.ndarray) -> None:
        order = np.argsort(keys)
        self.levels = [(keys[order], n[order])]
        for bits in (16, 8):
            self.levels.insert(0, np.unique(self.levels[0][0] & ((1 << bits) - 1), return_counts=True))
        self.contexts = []
        for table, n in self.levels:
            contexts, of = np.unique(table >> 8, return_inverse=True)
            sums = np.stack([np.bincount(of, w, len(contexts)) for w in (n, n == 1, n == 2, n > 2)]) if len(n) else np.zeros((4, 0))
            self.contexts.append((contexts, sums, discounts(*(int((n == k).sum()) for k in (1, 2, 3, 4)))))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -math.log(256))
        for i, ((table, n), (contexts, sums, cut)) in enumerate(zip(self.levels, self.contexts, strict=True)):
            own = keys & ((1 << (8 * (i + 1))) - 1)
            out = _interpolated(_looked_up(table, n[None], own)[0].astype(np.int64), _looked_up(contexts, sums, own >> 8), cut, out)
        return out


def _looked_up(table: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Columns of ``values`` by key, 0 for keys that the sorted table lacks."""
    if not len(table):
        return np.zeros((len(values), len(keys)))
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return values[:, at] * (table[at] == keys)


def _answers(level: int, parts: int):
    """A shard's answers: sums over all packs, one owner for each key that trusted text has, a pack whose own has it; and the tally of their counts."""

    def answer(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["pack"])
        sent = [np.cumsum(_unpacked(r["keys"], U), dtype=U) for r in rows]
        cuts = np.cumsum([0] + [len(s) for s in sent])
        _, first, place = _distinct(np.concatenate(sent))
        sums, own = np.zeros((parts, len(first)), np.int64), np.zeros(len(place), bool)
        for row, a, b in zip(rows, cuts, cuts[1:]):
            for part, values in zip(sums, _unpacked(row["parts"], np.int64).reshape(parts, -1)):
                np.add.at(part, place[a:b], values)
            own[a:b] = values > 0
        # Of the packs that count a key in trusted text, the first owns it: the last one written here.
        having = np.flatnonzero(own)[::-1]
        owners = np.full(len(first), -1)
        owners[place[having]] = having
        owner = np.zeros(len(place), bool)
        owner[owners[owners >= 0]] = True
        n = sums[-1].copy()
        if parts > 1:
            sums[0] -= sums[1] + 2 * sums[2]  # what followers of count 3 and more add: mostly nothing
        sums = sums.astype(np.min_scalar_type(int(sums.max(initial=0))))  # of as few bytes as they need
        tally = [int((n == k).sum()) for k in (1, 2, 3, 4)] + [int((n > 0).sum()), int(n.sum())]
        full = [None] * (len(rows) - 1)
        columns = [
            pa.array([r["pack"] for r in rows], pa.int64()), pa.array([level] * len(rows), pa.int32()), pa.array([r["shard"] for r in rows], pa.int32()),
            pa.array([_packed(sums[:, place[a:b]]) for a, b in zip(cuts, cuts[1:])], pa.binary()),
            pa.array([_packed(np.where(owner[a:b], n[place[a:b]], 0)) for a, b in zip(cuts, cuts[1:])], pa.binary()),
            pa.array([None, *full], pa.list_(pa.int32())), pa.array([tally, *full], pa.list_(pa.int64())),
        ]
        return pa.table(columns, names=["pack", "level", "shard", "data", "own", "places", "tally"])

    return answer


def log_probabilities(spark: SparkSession, texts: DataFrame, trusted: DataFrame | None = None, pack_words: int = PACK_WORDS,
                      shard_words: int = SHARD_WORDS) -> DataFrame:
    """``(h, logp, chars)`` for each distinct text of ``texts (id, learned, h, text)``; ``chars`` counts what is no white space.

    The model learns from rows with ``learned`` and from those whose id is in ``trusted (id)``.
    The files of an exchange are removed as soon as its step has ended.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        return _log_probabilities(spark, texts, trusted, pack_words, shard_words)
    finally:
        spark.conf.set(name, before)


def _log_probabilities(spark: SparkSession, texts: DataFrame, trusted: DataFrame | None, pack_words: int, shard_words: int) -> DataFrame:
    name, path = f"packs_{uuid.uuid4().hex}", f"{new_run_dir(spark, 'packs')}/t"
    buckets = min(100_000, int(spark.conf.get("spark.sql.shuffle.partitions")))
    written = texts.mapInArrow(lambda b: _packs(b, pack_words), _PACK).write.option("compression", "zstd")
    written.bucketBy(buckets, "pack").option("path", path).saveAsTable(name)
    packs = spark.table(name)
    total = packs.select(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).agg(F.sum("n")).first()[0] or 0
    rounds = max(ROUNDS.values())
    shards = rounds * max(1, math.ceil(total / shard_words / rounds))
    known = {}
    if trusted is not None:
        rows = packs.select("pack", F.posexplode("ids").alias("at", "id")).join(trusted.select("id").distinct().hint("merge"), "id")
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("data", "binary"), ("own", "binary"), ("tally", "array<bigint>"))]
        places = rows.groupBy("pack").agg(F.collect_list("at").alias("places"))
        places = places.select("pack", F.lit(TRUSTED).alias("level"), F.lit(0).alias("shard"), *nothing[:2], "places", nothing[2])
        known[TRUSTED] = [staged(places, "trusted")]

    def each(run, schema: str, *levels: int, chosen=None, column: str = "own") -> DataFrame:
        """``run`` of every pack, or of the chosen ones, that knows this column of the answers of these levels."""
        side = [df for level in levels for df in known.get(level, [])]
        if not side:
            return packs.mapInArrow(lambda b: (t for x in b for r in x.to_pylist() for t in run(Pack(r, [], shards)).to_batches()), schema)
        answers = side[0]
        for more in side[1:]:
            answers = answers.unionAll(more)
        opened = lambda left, right: run(Pack(left.to_pylist()[0], right.to_pylist(), shards))
        own = packs if chosen is None else packs.where(chosen)
        answers = (answers if chosen is None else answers.where(chosen)).select("pack", "level", "shard", column, "places").withColumnRenamed("pack", "to")
        return own.groupBy("pack").cogroup(answers.groupBy("to")).applyInArrow(opened, schema)

    steps = [(TRIGRAM, Pack.ask_trigrams, 1, (TRUSTED,)), (PAIR, Pack.ask_pairs, 5, (TRUSTED, TRIGRAM)),
             (WORD, Pack.ask_words, 5, (TRUSTED, PAIR))]
    tallies = {}
    for level, question, parts, needs in steps:
        known[level] = []
        for part in range(ROUNDS[level]):
            part_of = (shards * part // ROUNDS[level], shards * (part + 1) // ROUNDS[level])
            asked = each(lambda pack, q=question, p=part_of: q(pack, p), _QUESTION, *needs)
            answers = asked.groupBy("shard").applyInArrow(_answers(level, parts), _ANSWER)
            known[level].append(staged(answers, "answers"))
        tally = known[level][0]
        for more in known[level][1:]:
            tally = tally.unionAll(more)
        found = tally.agg(*[F.sum(F.col("tally")[i]) for i in range(6)]).first()
        tallies[level] = [int(x or 0) for x in found]
    for df in known.pop(TRUSTED, []):
        discard(df)
    letters = each(lambda pack: pack.spellings(), "key bigint, n bigint", WORD).groupBy("key").agg(F.sum("n").alias("n"))
    letters = letters.toPandas()  # at most 2^24 rows
    spelled = Spelling(letters["key"].to_numpy(np.int64), letters["n"].to_numpy(np.int64))
    scored = []
    for part in range(SCORE_ROUNDS):  # answers are dealt to the packs of one part at a time, which bounds the disk
        own = F.pmod(F.xxhash64("pack"), F.lit(SCORE_ROUNDS)) == part
        scored.append(staged(each(lambda pack: pack.scores(tallies, spelled), "h bigint, logp double, chars int", WORD, PAIR, TRIGRAM, chosen=own, column="data"), "scored"))
    scores = scored[0]
    for more in scored[1:]:
        scores = scores.unionAll(more)
    scores = staged(scores.groupBy("h").agg(F.min("logp").alias("logp"), F.min("chars").alias("chars")), "scores")
    for df in [df for level in known.values() for df in level] + scored:
        discard(df)
    spark.sql(f"DROP TABLE {name}")
    folders.delete(spark, path.rsplit("/", 1)[0])
    return scores
