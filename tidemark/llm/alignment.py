"""Alignment of the tokens that two tokenizers make of the same text.

Both tokenizers cut the bytes of a text; where a token of A and a token of B end at the same byte,
both cut, and the tokens between two such cuts are a group.  Finding the cuts is a merge of two
ascending lists of ends.  It is divided by merge paths: a binary search along each of a row of
diagonals of the A/B grid finds where the merge crosses it, so the ends fall into pieces of equal
work that don't depend on each other, whatever the lengths of the texts.  A piece emits the pairs
of tokens that end together; a cut whose two ends fall into neighbouring pieces belongs to the
later one, and the pieces' cuts, in order, are stitched into the groups of each document.

The vocabulary files are read once by the driver and sent along with the function (a few
megabytes, whatever the corpus).  Encoding, checking and aligning run on slices of about a
megabyte of text; tokens stay arrays throughout.

A pair of ids can only be linked if the bytes of one end with those of the other, so the table of
counts has at most as many rows as the tokens of both vocabularies have bytes together (some
700 000 for those used here): that is the bound of the broadcast in :func:`link_counts`.

Edge cases: a text that is null, empty, or not what both tokenizers' tokens spell (A and B read
it behind one space) has no tokens, and its numbers are 0.  Rows of equal id are separate
documents.  A very long text is a slice of its own and is merged in many pieces.  Result columns
replace columns of the same name.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.store import staged
from tidemark.llm.words import slices, text_bytes

#: Ends that a piece of the merge has.
WORK = 1 << 15

# Fixed value: the pattern by which byte-level vocabularies of this kind split a text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_PAIR = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())])
_ADDED = {
    "n_a": (T.LongType(), pa.int64()), "n_b": (T.LongType(), pa.int64()), "n_groups": (T.LongType(), pa.int64()),
    "groups": (T.StringType(), pa.string()), "groups_sha256": (T.StringType(), pa.string()),
    "links": (T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in "abn"])), pa.list_(_PAIR)),
}


@dataclass(frozen=True)
class Vocabularies:
    """The contents of a byte-level BPE file (A) and of a sentence-piece model (B)."""

    a: str
    b: bytes

    @classmethod
    def read(cls, a: str, b: str) -> Vocabularies:
        with open(a, encoding="utf-8") as one, open(b, "rb") as other:
            return cls(one.read(), other.read())


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Tokenizer A.  The vocabulary's merges are in the order of its ids, which is checked, so ids are ranks."""

    def __init__(self, content: str):
        import tiktoken

        letters, file = _byte_letters(), json.loads(content)
        special = {t["content"] for t in file["added_tokens"]}
        vocabulary, merges = file["model"]["vocab"], file["model"]["merges"]
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in special}
        joined = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
        if [vocabulary[t] for t in joined] != list(range(256, 256 + len(joined))) or file["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("not a byte-level vocabulary whose merges are in the order of the ids")
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        self._encoding = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self._encoding.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]


class Pieces:
    """Tokenizer B; it sets the space before the text itself."""

    def __init__(self, content: bytes):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.tokens = [self._bytes(i) for i in range(self._model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self._model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self._model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self._model.encode(texts, num_threads=1)]


def crossings(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two ascending lists crosses every ``work``-th diagonal: the numbers taken of each, from 0 to all.

    Equal ends are taken from ``a`` first.  All diagonals are searched at once.
    """
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        taken = np.zeros(len(low), bool)
        taken[open_] = a[middle[open_]] <= b[diagonal[open_] - 1 - middle[open_]]
        low, high = np.where(open_ & taken, middle + 1, low), np.where(open_ & ~taken, middle, high)
    return low, diagonal - low


def cuts(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b``, both strictly ascending, of their common values, piece by piece of the merge."""
    in_a, in_b = crossings(a, b, work)
    found = [(np.zeros(0, np.int64),) * 2]
    for k in range(len(in_a) - 1):
        # An end of a that closed the last piece meets its equal of b here.
        begin = max(0, in_a[k] - 1)
        of_a, of_b = a[begin : in_a[k + 1]], b[in_b[k] : in_b[k + 1]]
        at = np.searchsorted(of_a, of_b)
        equal = at < len(of_a)
        equal[equal] = of_a[at[equal]] == of_b[equal]
        found.append((begin + at[equal], in_b[k] + np.flatnonzero(equal)))
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


class Aligner:
    """Both tokenizers and what their ids stand for."""

    def __init__(self, vocabularies: Vocabularies):
        self.coders = (ByteLevel(vocabularies.a), Pieces(vocabularies.b))
        self.bytes = [pa.array(c.tokens, pa.large_binary()) for c in self.coders]
        self.size = [np.array([len(t) for t in c.tokens], np.int64) for c in self.coders]
        n_a, n_b = (len(c.tokens) for c in self.coders)
        # Ids as the groups' text has them: behind an id of A comes `,` or, at the group's end, `|`; behind one of B `,`, `;` or nothing.
        self.words = pa.array([f"{i}{e}".encode() for n, ends in ((n_a, ",|"), (n_b, [",", ";", ""])) for i in range(n) for e in ends], pa.large_binary())
        self.first_b = 2 * n_a

    def _spelled(self, ids: np.ndarray, side: int) -> np.ndarray:
        data = self.bytes[side].take(pa.array(ids)).buffers()[2]
        return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)

    def encode(self, column: pa.Array):
        """Per side the ids of the documents that both tokenizers spell, and which rows these are."""
        data, offsets = text_bytes(column)
        raw = [data[offsets[i] : offsets[i + 1]].tobytes() for i in range(len(column))]
        rows = [i for i, t in enumerate(raw) if t]
        texts = [raw[i].decode("utf-8", "replace") for i in rows]
        sides = [c.encode(texts) for c in self.coders]
        ends = [np.cumsum([0] + [self.size[s][ids].sum() for ids in side]) for s, side in enumerate(sides)]
        spelled = [self._spelled(np.concatenate(side), s) if side else np.zeros(0, np.uint8) for s, side in enumerate(sides)]
        right = []
        for k, i in enumerate(rows):
            wanted = b" " + raw[i]
            if all(spelled[s][ends[s][k] : ends[s][k + 1]].tobytes() == wanted for s in (0, 1)):
                right.append(k)
        return [[side[k].astype(np.int64) for k in right] for side in sides], np.array([rows[k] for k in right], np.int64)

    def align(self, column: pa.Array, wanted: list[str]) -> dict[str, pa.Array]:
        """The wanted columns for every row."""
        rows = len(column)
        (per_a, per_b), at = self.encode(column)
        out = {c: np.zeros(rows, np.int64) for c in ("n_a", "n_b", "n_groups")}
        texts, digests = [""] * rows, [""] * rows
        link_sizes, links = np.zeros(rows, np.int64), np.zeros((3, 0), np.int64)
        if len(at):
            ids = [np.concatenate(per_a), np.concatenate(per_b)]
            ends = [np.cumsum(self.size[s][ids[s]]) for s in (0, 1)]
            cut_a, cut_b = cuts(*ends)
            doc_a, doc_b = (np.cumsum([len(x) for x in side]) for side in (per_a, per_b))
            doc_cut = np.searchsorted(cut_a, doc_a - 1) + 1  # a text's last tokens end together
            out["n_a"][at], out["n_b"][at] = np.diff(doc_a, prepend=0), np.diff(doc_b, prepend=0)
            out["n_groups"][at] = np.diff(doc_cut, prepend=0)
            if {"groups", "groups_sha256"} & set(wanted):
                for row, text in zip(at, self._written(ids, cut_a, cut_b, doc_cut), strict=True):
                    if "groups" in wanted:
                        texts[row] = text.decode()
                    digests[row] = hashlib.sha256(text).hexdigest()
            if "links" in wanted:
                doc = np.repeat(at, np.diff(doc_cut, prepend=0))
                width = len(self.coders[1].tokens)
                code = (doc * len(self.coders[0].tokens) + ids[0][cut_a]) * width + ids[1][cut_b]
                code, n = np.unique(code, return_counts=True)
                pair, b = np.divmod(code, width)
                doc, a = np.divmod(pair, len(self.coders[0].tokens))
                links, link_sizes = np.stack([a, b, n]), np.bincount(doc, minlength=rows)
        columns = {c: pa.array(v) for c, v in out.items()}
        columns |= {"groups": pa.array(texts, pa.string()), "groups_sha256": pa.array(digests, pa.string())}
        struct = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in links], fields=list(_PAIR))
        columns["links"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(link_sizes)]).astype(np.int32)), struct)
        return {c: columns[c] for c in wanted}

    def _written(self, ids: list[np.ndarray], cut_a: np.ndarray, cut_b: np.ndarray, doc_cut: np.ndarray) -> Iterator[memoryview]:
        """The groups of each document as text."""
        place_a, place_b = np.arange(len(ids[0])), np.arange(len(ids[1]))
        group_a, group_b = np.searchsorted(cut_a, place_a), np.searchsorted(cut_b, place_b)
        last = np.zeros(len(cut_a), bool)
        last[doc_cut - 1] = True
        word = np.zeros(len(ids[0]) + len(ids[1]), np.int64)
        before_b = np.concatenate([[0], cut_b + 1])
        word[place_a + before_b[group_a]] = ids[0] * 2 + (place_a == cut_a[group_a])
        ending = np.where(place_b == cut_b[group_b], np.where(last[group_b], 2, 1), 0)
        word[place_b + cut_a[group_b] + 1] = self.first_b + ids[1] * 3 + ending
        written = self.words.take(pa.array(word))
        offsets = np.frombuffer(written.buffers()[1], np.int64)[written.offset :]
        data = memoryview(written.buffers()[2])
        ends = offsets[(cut_a + cut_b + 2)[doc_cut - 1]]
        for begin, end in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
            yield bytes(data[begin:end])


def align(docs: DataFrame, vocabularies: Vocabularies, text: str = "text", wanted: tuple[str, ...] = ("n_a", "n_b", "n_groups", "groups", "links")) -> DataFrame:
    """The columns of ``docs`` but the text, with the wanted ones of ``n_a, n_b, n_groups, groups, groups_sha256, links``.

    ``groups`` is written ``a1,a2|b1;a3|b2,b3``; ``links`` has every distinct pair of ids that end
    together, with its number ``n`` in the document.
    """
    kept = [c for c in docs.columns if c not in wanted and c != text]
    fields = [docs.schema[c] for c in kept] + [T.StructField(c, _ADDED[c][0]) for c in wanted]
    names = list(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(vocabularies)
        for batch in batches:
            for piece in slices(batch, text):
                made = aligner.align(piece.column(text), names)
                columns = [piece.column(c) for c in kept] + [made[c].cast(_ADDED[c][1]) for c in names]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

    return docs.select(*[F.col(f"`{c}`") for c in [*kept, text]]).mapInArrow(run, T.StructType(fields))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a, b, total, best``: the links of the whole corpus by id pair, and whether it is its B id's most frequent one."""
    counts = aligned.select(F.inline("links")).groupBy("a", "b").agg(F.sum("n").alias("total"))
    return counts.withColumn("best", F.col("total") == F.max("total").over(Window.partitionBy("b")))


def link_counts(aligned: DataFrame, counts: DataFrame, row: str) -> DataFrame:
    """``row, n_links, n_best, count_sum`` of every document that has links.

    ``counts`` is broadcast: its rows are bounded by the vocabularies, whatever the corpus.
    """
    each = aligned.select(row, F.inline("links")).join(F.broadcast(counts), ["a", "b"])
    best = F.when(F.col("best"), F.col("n")).otherwise(0)
    return each.groupBy(row).agg(
        F.sum("n").alias("n_links"), F.sum(best).alias("n_best"), F.sum(F.col("n") * F.col("total")).alias("count_sum")
    )


def aligned_counts(docs: DataFrame, vocabularies: Vocabularies, text: str = "text", wanted: tuple[str, ...] = ("n_a", "n_b", "n_groups", "groups_sha256")) -> DataFrame:
    """:func:`align` with ``n_links, n_best, count_sum`` for the links; every text is encoded once."""
    row = "_row"
    while row in docs.columns:
        row += "_"
    marked = docs.withColumn(row, F.monotonically_increasing_id())
    aligned = staged(align(marked, vocabularies, text, (*wanted, "links")), "aligned")
    sums = link_counts(aligned, staged(pair_counts(aligned), "pair-counts"), row)
    columns = ["n_links", "n_best", "count_sum"]
    kept = [c for c in aligned.columns if c not in ("links", row, *columns)]
    joined = aligned.select(row, *[F.col(f"`{c}`") for c in kept]).join(sums, row, "left")
    return joined.select(*[F.col(f"`{c}`") for c in kept], *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in columns])
