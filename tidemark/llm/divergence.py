"""How the sources of a language differ in their words.

Terms are counted for every group (language, source).  A language keeps the terms that enough of
its documents have; smoothed by a constant, the counts become whole parts per billion, and two
groups differ by the sum of the absolute differences over all kept terms.

The sums are made row by row (Gustavson): the kept terms form a term-major index, a row per term
with the groups that have it.  A task holds one shard of the index; each group scatters its own
terms through that shard's rows into a dense accumulator with a place per peer, so that no pair
of postings ever becomes a row.  What groups have that lack a term, the zero baseline, differs
from group to group; it is corrected exactly::

    sum |p_g - p_h| = |terms| |b_g - b_h| + E_g(h) + E_h(g)
                      + sum over shared terms (|p_g - p_h| - |p_g - b_h| - |b_g - p_h| + |b_g - b_h|)
    E_g(h) = sum over g's terms (|p_g - b_h| - |b_g - b_h|)

with ``b`` a group's share of an absent term.  ``E`` needs a group's sorted shares and their
running sums only.  A shard sends one number per ordered pair of groups, which Spark adds up.

All arithmetic is on whole numbers.  A row of the index and a group's peers are at most as many
as a language has sources, whose square is the size of the result itself; a task
makes the rows of one block of groups, so accumulators stay bounded.  Counts are summed in the map tasks before they move.

Edge cases: null text, language or source count as the empty text.  A group whose documents have
no kept term is a group with counts 0; a language without kept terms gives its pairs the value 0
and no term.  Rows of equal id are separate documents.  An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import staged
from tidemark.llm.words import LOWER as FOLD
from tidemark.llm.words import slices, text_bytes

SCALE = 1_000_000_000
SMOOTH = 5
#: Postings that a task holds, and numbers that its accumulators have.
SHARD, CELLS = 50_000, 1 << 20
#: Terms that a task counts before it sends the counts on.
HELD = 500_000

PAIRS = "lang string, source string, item string, value bigint"


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences in the group and documents of it that have the term.

    A task adds up what it finds and sends it on whenever it holds :data:`HELD` terms.
    """
    named = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))]
    found = docs.select(*named).mapInArrow(_count_terms, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # In UTF-8 the terms are the runs of ASCII letters and bytes above 127.
    term = re.compile(rb"[a-z\x80-\xff]+")
    held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
    for batch in batches:
        for piece in slices(batch, "text"):
            data, offsets = text_bytes(piece.column("text"))
            whole = FOLD[data].tobytes()
            groups = zip(piece.column("lang").to_pylist(), piece.column("source").to_pylist(), strict=True)
            for group, begin, end in zip(groups, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                terms = term.findall(whole, begin, end)
                n, docs = held[group]
                n.update(terms)
                docs.update(set(terms))
            if sum(len(n) for n, _ in held.values()) > HELD:
                yield from _sent(held)
                held.clear()
    yield from _sent(held)


def _sent(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in held.items():
        terms = pa.array(list(n), pa.binary()).cast(pa.string())
        columns = [pa.array([v] * len(n), pa.string()) for v in (lang, source)]
        numbers = [pa.array([c[t] for t in n], pa.int64()) for c in (n, docs)]
        yield pa.RecordBatch.from_arrays([*columns, terms, *numbers], names=["lang", "source", "term", "n", "docs"])


def term_index(counts: DataFrame, least: int) -> DataFrame:
    """The term-major index: ``lang, term, n`` and ``row``, the ``(source, n)`` of every group that has the term."""
    rows = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("row")
    )
    return rows.where(F.col("docs") >= least).drop("docs")


def share(n: Column, total: Column, terms: Column) -> Column:
    """Whole parts per billion plus one, exactly."""
    up = (n + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    down = (total + SMOOTH * terms).cast("decimal(20,0)")
    return F.call_function("div", up, F.when(down > 0, down)) + 1


def group_totals(docs: DataFrame, index: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, place, total, terms, lang_total`` of every group; ``place`` numbers the sources of a language."""
    named = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"))]
    groups = docs.select(*named).distinct()
    sums = index.select("lang", F.inline("row")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = index.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_total"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    zero = F.lit(0).cast("long")
    return (
        groups.withColumn("place", place).join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", "place", *[F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")])
    )


def shares_of(n: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """:func:`share` of arrays, by long division to base 1000 so that nothing exceeds 64 bits."""
    down = total + SMOOTH * terms
    whole, rest = np.divmod(n + SMOOTH, down)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, down)
        whole = whole * 1000 + digit
    return whole + 1


def scatter(term: np.ndarray, place: np.ndarray, p: np.ndarray, base: np.ndarray, n_terms: int, first: int, last: int) -> np.ndarray:
    """``sums[i, h]``: the divergence of groups ``first + i`` (up to ``last``) and ``h`` over a shard's terms.

    ``term, place, p`` are the postings, of terms ``0 .. n_terms - 1``; ``base[h]`` is the share of an absent term.
    """
    peers = len(base)
    by_term, by_place = np.argsort(term, kind="stable"), np.argsort(place, kind="stable")
    rows = np.searchsorted(term[by_term], np.arange(n_terms + 1))
    columns = np.searchsorted(place[by_place], np.arange(peers + 1))
    peer_of, share_of = place[by_term], p[by_term]

    def excess(of: int, against: np.ndarray) -> np.ndarray:
        own = np.sort(p[by_place[columns[of] : columns[of + 1]]])
        upto = np.concatenate([[0], np.cumsum(own)])
        less = np.searchsorted(own, against)
        total = against * less - upto[less] + (upto[-1] - upto[less]) - against * (len(own) - less)
        return total - len(own) * np.abs(base[of] - against)

    sums = n_terms * np.abs(base[first:last, None] - base[None, :])
    for g in range(first, last):
        sums[g - first] += excess(g, base)
        own = by_place[columns[g] : columns[g + 1]]
        for piece in np.array_split(own, len(own) * peers // CELLS + 1):
            begin, long = rows[term[piece]], rows[term[piece] + 1] - rows[term[piece]]
            at = np.repeat(begin - np.cumsum(long) + long, long) + np.arange(long.sum())
            h, ph, pg, bg = peer_of[at], share_of[at], np.repeat(p[piece], long), base[g]
            change = np.abs(pg - ph) - np.abs(pg - base[h]) - np.abs(bg - ph) + np.abs(bg - base[h])
            np.add.at(sums[g - first], h, change)
    for h in range(peers):
        sums[:, h] += excess(h, base[first:last])
    return sums


def _shard_pairs(key: tuple, postings: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """The pairs of one block of a language's groups over one shard of its terms."""
    groups = groups.sort_values("place")
    names, total, terms = groups["source"].to_numpy(), groups["total"].to_numpy(np.int64), int(groups["terms"].max() or 0)
    block = max(1, CELLS // max(1, len(names)))
    first = min(key[2] * block, len(names))
    last = min(first + block, len(names))
    term, known = pd.factorize(postings["term"])
    place, n = pd.Index(names).get_indexer(postings["source"]), postings["n"].to_numpy(np.int64)
    base = shares_of(np.zeros(len(names), np.int64), total, terms) if terms else np.zeros(len(names), np.int64)
    p = shares_of(n, total[place], terms) if len(n) else n
    sums = scatter(term.astype(np.int64), place.astype(np.int64), p, base, len(known), first, last)
    others = np.arange(len(names))[None, :] != np.arange(first, last)[:, None]
    group, peer = np.nonzero(others)
    return pd.DataFrame({"lang": key[0], "source": names[first + group], "item": names[peer], "value": sums[others]})


def pair_divergence(index: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every ordered pair of sources of a language."""
    postings = index.agg(F.coalesce(F.sum(F.size("row")), F.lit(0)).alias("n")).first()["n"]
    peers = groups.agg(F.coalesce(F.max("place"), F.lit(0)).alias("n")).first()["n"] + 1
    shards, blocks = postings // SHARD + 1, -(-peers // max(1, CELLS // peers))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = index.withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int")).withColumn("block", every)
    left = left.select("lang", "shard", "block", "term", F.inline("row"))
    right = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("block", every)
    keys = ["lang", "shard", "block"]
    sums = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_shard_pairs, PAIRS)
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_excess(index: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: by how much a group's terms exceed their share in the language."""
    rows = index.select("lang", "term", F.col("n").alias("all"), F.inline("row"))
    known = rows.join(groups.drop("place"), ["lang", "source"])
    value = share(F.col("n"), F.col("total"), F.col("terms")) - share(F.col("all"), F.col("lang_total"), F.col("terms"))
    return known.select("lang", "source", F.col("term").alias("item"), value.alias("value")).where("value > 0")


def audit(docs: DataFrame, least: int = 30, top: int = 50) -> DataFrame:
    """``lang, source, part, item, value, rank``: all pairs of sources, and the ``top`` terms of each."""
    index = staged(term_index(staged(term_counts(docs), "term-counts"), least), "term-index")
    groups = staged(group_totals(docs, index), "groups")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = [
        part.withColumn("part", F.lit(name)).withColumn("rank", F.row_number().over(order))
        for name, part in (("pair", pair_divergence(index, groups)), ("term", term_excess(index, groups)))
    ]
    ranked[1] = ranked[1].where(F.col("rank") <= top)
    return ranked[0].unionByName(ranked[1]).select("lang", "source", "part", "item", "value", "rank")
