"""Language identification: scripts narrow the candidates, Viterbi labels spans of mixed text.

A word's score for a language is the sum of the log probabilities of its letter trigrams
and of the word itself, both hashed into tables of fixed size.  The best sequence of
languages pays a penalty for every switch between consecutive words.

Edge cases: a null text, an empty one and one without a letter give ``und``, score 0 and no
span.  A script that no language was learned with leaves every language a candidate.  Equal
scores go to the language that sorts first.  Without any labelled row every text is ``und``.
Repeated rows are judged alike, other columns are kept; result columns of the same name are
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import U, mix, slices

UNDETERMINED = "und"
RESULT = "struct<lang:string,score:double,spans:array<struct<begin:int,end:int,lang:string>>>"
# First code points of the blocks in which a script's letters stand, up to the next entry.
SCRIPT_STARTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"), (0xFB50, "arabic"), (0xFE00, "other"),
    (0xFF21, "latin"), (0xFF5B, "other"), (0xFF66, "kana"), (0xFFA0, "other"),
    (0x1AFF0, "kana"), (0x1B170, "other"), (0x1D400, "latin"), (0x1D6A8, "greek"), (0x1D7CC, "other"), (0x20000, "han"),
]
SCRIPTS = sorted({name for _, name in SCRIPT_STARTS})
#: No letter lies beyond the planes up to here.
_PLANES = 4 << 16
_STARTS = np.array([start for start, _ in SCRIPT_STARTS])
_SCRIPT = np.array([SCRIPTS.index(name) for _, name in SCRIPT_STARTS], np.uint8)[
    np.searchsorted(_STARTS, np.arange(_PLANES), "right") - 1
]
_LETTER = np.array([chr(c).isalpha() for c in range(_PLANES)])
_LOWER = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in range(_PLANES)], np.uint32)
BUCKETS = 1 << 16
#: Bytes of text taken at a time: arrays over its letters take about a hundred times as much.
PIECE = 1 << 18


@dataclass
class Spoken:
    """Words of a slice: letters with the word each belongs to, and the words' places."""

    row: np.ndarray
    begin: np.ndarray  # code points within the row
    length: np.ndarray
    script: np.ndarray
    features: np.ndarray  # buckets, one per letter and one per word
    word: np.ndarray  # the word of each feature


def spoken(texts: list[str]) -> Spoken:
    joined = "\n".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    row_start = np.cumsum([0] + [len(t) + 1 for t in texts])
    narrow = np.minimum(codes, _PLANES - 1)
    letter = _LETTER[narrow]
    padded = np.concatenate([[False], letter, [False]])
    start = np.flatnonzero(padded[1:] & ~padded[:-1])
    end = np.flatnonzero(~padded[1:] & padded[:-1])
    length = end - start
    row = np.searchsorted(row_start, start, "right") - 1
    low = np.where(letter, _LOWER[narrow], 0).astype(U)
    around = np.concatenate([[U(0)], low, [U(0)]])
    three = mix((around[:-2] << U(40)) ^ (around[1:-1] << U(20)) ^ around[2:], 1)[letter]
    word_of = np.repeat(np.arange(len(start)), length)
    if len(start):
        at = np.cumsum(length) - length
        place = np.arange(len(word_of)) - np.repeat(at, length)
        whole = np.add.reduceat(mix(low[letter] + U(0x9E3779B9) * place.astype(U), 2), at)
    else:
        whole = np.zeros(0, U)
    mask = U(BUCKETS - 1)
    features = np.concatenate([three & mask, (mix(whole, 3) & mask) + U(BUCKETS)]).astype(np.int64)
    return Spoken(row, start - row_start[row], length, _SCRIPT[narrow[start]] if len(start) else np.zeros(0, np.uint8),
                  features, np.concatenate([word_of, np.arange(len(start))]))


@dataclass
class LanguageModel:
    """``table`` has the log probability of each bucket per language, ``writes`` the scripts of each."""

    langs: list[str]
    table: np.ndarray
    writes: np.ndarray
    penalty: float

    def word_scores(self, words: Spoken) -> np.ndarray:
        gained = np.zeros((len(words.row), len(self.langs)))
        for k in range(len(self.langs)):
            gained[:, k] = np.bincount(words.word, self.table[words.features, k], len(words.row))
        allowed = self.writes[words.script]
        return np.where(allowed | ~allowed.any(axis=1, keepdims=True), gained, -1e4)

    def label(self, scores: np.ndarray) -> np.ndarray:
        """The best language of each word of one document."""
        totals = scores.sum(axis=0)
        best = int(np.argmax(totals))
        if len(self.langs) == 1:
            return np.zeros(len(scores), np.int64)
        gain = np.delete(scores, best, axis=1).max(axis=1) - scores[:, best]
        run = np.concatenate([[0.0], np.cumsum(gain)])
        # No stretch in other languages gains what the switch to it costs: one language is the best sequence.
        if run[-1] <= 0 and (run - np.minimum.accumulate(run)).max() <= self.penalty:
            return np.full(len(scores), best)
        return np.array(best_sequence(scores.tolist(), self.penalty))


def best_sequence(scores: list[list[float]], penalty: float) -> list[int]:
    """Viterbi with one penalty for any switch; ties stay, then go to the first state."""
    reached, history = scores[0], []
    for row in scores[1:]:
        top = max(reached)
        history.append((reached, top))
        floor = top - penalty
        reached = [(a if a >= floor else floor) + b for a, b in zip(reached, row, strict=True)]
    state = reached.index(max(reached))
    out = [state]
    for before, top in reversed(history):
        if before[state] < top - penalty:
            state = before.index(top)
        out.append(state)
    return out[::-1]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = 3000,
        penalty: float = 12.0) -> LanguageModel:
    """Learn from rows with a language; ``per_language`` bounds the expected sample of each language."""
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = sorted((r[0], r[1]) for r in labelled.groupBy(lang).count().collect())
    langs = [name for name, _ in rows]
    if not langs:
        return LanguageModel([], np.zeros((2 * BUCKETS, 0)), np.zeros((len(SCRIPTS), 0), bool), penalty)
    place = F.pmod(F.xxhash64(F.lit(11), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.create_map(*[F.lit(x) for name, n in rows for x in (name, min(1.0, per_language / n))])
    sample = labelled.filter(place < share[F.col(lang)]).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counted = (
        sample.mapInArrow(lambda batches: _count(batches, langs), "lang int, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    )  # at most languages x buckets rows
    counts = np.zeros((2 * BUCKETS + len(SCRIPTS), len(langs)))
    counts[counted["bucket"], counted["lang"]] = counted["n"]
    scripts = counts[2 * BUCKETS :]
    table = []
    for part in (counts[:BUCKETS], counts[BUCKETS : 2 * BUCKETS]):
        table.append(np.log(part + 0.2) - np.log(part.sum(axis=0) + 0.2 * BUCKETS))
    writes = scripts > 0.01 * np.maximum(1, scripts.sum(axis=0))
    return LanguageModel(langs, np.concatenate(table).astype(np.float32), writes, penalty)


def _count(batches, langs: list[str]):
    code = {name: k for k, name in enumerate(langs)}
    width = 2 * BUCKETS + len(SCRIPTS)
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch, "text", PIECE):
            words = spoken([t or "" for t in part.column("text").to_pylist()])
            of_row = np.array([code[x] for x in part.column("lang").to_pylist()])
            for k in np.unique(of_row):
                mine = of_row[words.row] == k
                add = np.bincount(words.features[mine[words.word]], minlength=width)
                add += np.bincount(2 * BUCKETS + words.script[mine].astype(np.int64), words.length[mine], width).astype(np.int64)
                sums[k] = sums.get(k, 0) + add
    for k, total in sums.items():
        full = np.flatnonzero(total)
        yield pa.record_batch([pa.array(np.full(len(full), k, np.int32)), pa.array(full.astype(np.int32)), pa.array(total[full])],
                              names=["lang", "bucket", "n"])


def _identify(model: LanguageModel, text: pa.Array) -> list[dict]:
    out = []
    for part in slices(pa.record_batch([text], names=["text"]), "text", PIECE):
        texts = [t or "" for t in part.column(0).to_pylist()]
        words = spoken(texts)
        scores = model.word_scores(words)
        first = np.searchsorted(words.row, np.arange(len(texts) + 1))
        for a, b in zip(first[:-1], first[1:], strict=True):
            if a == b or not model.langs:
                out.append({"lang": UNDETERMINED, "score": 0.0, "spans": []})
                continue
            labels = model.label(scores[a:b])
            letters = np.bincount(labels, words.length[a:b], len(model.langs))
            top = int(np.argmax(letters))
            turn = np.flatnonzero(np.diff(labels)) + 1
            heads, tails = np.concatenate([[0], turn]), np.concatenate([turn, [b - a]]) - 1
            spans = [
                {"begin": int(words.begin[a + h]), "end": int(words.begin[a + t] + words.length[a + t]), "lang": model.langs[labels[h]]}
                for h, t in zip(heads, tails, strict=True)
            ]
            out.append({"lang": model.langs[top], "score": float(letters[top] / letters.sum()), "spans": spans})
    return out


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` (the language's share of the letters) and ``lang_spans``."""
    shape = pa.struct([("lang", pa.string()), ("score", pa.float64()), (
        "spans", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))])

    @F.arrow_udf(RESULT)
    def judge(column: pa.Array) -> pa.Array:
        return pa.array(_identify(model, column), shape)

    docs = docs.drop("lang_pred", "lang_score", "lang_spans", "_judged").withColumn("_judged", judge(F.col(text)))
    return docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c != "_judged"], F.col("_judged.lang").alias("lang_pred"),
        F.col("_judged.score").alias("lang_score"), F.col("_judged.spans").alias("lang_spans"),
    )
