"""Near-duplicate documents: dart signatures, banded join, exact check, classes.

Texts are sets of runs of five words; two texts are linked when the Jaccard similarity of
their sets is 0.8 or more, and a class is a connected component of links.  Equal sets are
one node from the start.  40 bands of 6 coordinates miss a pair of similarity 0.8 with a
probability of 5e-6.

A bucket of one band may hold many nodes, and links are not transitive.  Its smallest node is
compared with every other member; where all are linked to it the bucket is done, as large
groups of copies mostly are.  In the others all members are compared, chunk with chunk, inside
tasks: a chunk has a bounded number of runs of words, and a pair of chunks returns a spanning
forest of its links, never the pairs.

Edge cases: a text of one to four words is a set of one run; a null text or one without
words links with nothing and is its own class.  Rows with equal ids are separate texts.  The
class id is the smallest id of the class, null where no member has one.  An empty table
gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.darts import band_hashes, set_identity, shingles, signatures
from tidemark.llm.graph import components
from tidemark.llm.store import staged
from tidemark.llm.words import slices, split_words

ROWS = 512
#: Runs of words in one chunk of a bucket that is compared in a task.
CHUNK_ITEMS = 200_000


def _pieces(column: pa.Array):
    for part in slices(pa.record_batch([column], names=["text"]), "text"):
        for at in range(0, part.num_rows, ROWS):
            yield part.column(0).slice(at, min(ROWS, part.num_rows - at))


def _nodes(row: np.ndarray, item: np.ndarray, rows: int) -> pa.Array:
    identity = set_identity(row, item, rows)
    some = np.bincount(row, minlength=rows) > 0
    return pa.array([bytes(x) if y else None for x, y in zip(identity.view("V16").ravel(), some, strict=True)], pa.binary())


def _lists(values: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def sketch(text, size: int, bands: int, band_rows: int, counted: bool):
    """Column expression: the node of a text and its band hashes."""

    @F.arrow_udf("struct<node:binary,bands:array<bigint>>")
    def run(column: pa.Array) -> pa.Array:
        out = []
        for part in _pieces(column):
            rows = len(part)
            row, item = shingles(split_words(part), rows, size, counted)
            kept = band_hashes(signatures(row, item, rows, bands * band_rows), bands, band_rows)
            some = np.bincount(row, minlength=rows) > 0
            lists = _lists(kept[some].ravel(), np.repeat(np.flatnonzero(some), bands), rows)
            out.append(pa.StructArray.from_arrays([_nodes(row, item, rows), lists], ["node", "bands"]))
        return pa.concat_arrays(out) if out else pa.array([], pa.struct([("node", pa.binary()), ("bands", pa.list_(pa.int64()))]))

    return run(text)


def shingle_sets(text, size: int, counted: bool):
    """Column expression: the node of a text and its runs of words."""

    @F.arrow_udf("struct<node:binary,items:array<bigint>>")
    def run(column: pa.Array) -> pa.Array:
        out = []
        for part in _pieces(column):
            rows = len(part)
            row, item = shingles(split_words(part), rows, size, counted)
            out.append(pa.StructArray.from_arrays([_nodes(row, item, rows), _lists(item, row, rows)], ["node", "items"]))
        return pa.concat_arrays(out) if out else pa.array([], pa.struct([("node", pa.binary()), ("items", pa.list_(pa.int64()))]))

    return run(text)


def _similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``(a, b)`` whose sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return (
        pairs.join(left, "a").join(right, "b")
        .filter(shared >= threshold * (F.size("of_a") + F.size("of_b") - shared)).select("a", "b")
    )


def _star(buckets: DataFrame) -> DataFrame:
    """``(h, a, b)``: every bucket's smallest node with each other member."""
    centre = buckets.groupBy("h").agg(F.min("node").alias("a"))
    return buckets.join(centre, "h").filter("node <> a").select("h", "a", F.col("node").alias("b"))


def _compared(parts: DataFrame, threshold: float) -> DataFrame:
    """A spanning forest of the links in each group ``(h, i, j)`` of ``parts (.., chunk, node, items)``.

    Members of chunk ``i`` are compared with those of chunk ``j``, each with all at once.
    """

    def compare(group: pa.Table) -> pa.Table:
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        group = group.sort_by("node")
        node = group.column("node").to_pylist()
        chunk = np.asarray(group.column("chunk"))
        lists = group.column("items").combine_chunks()
        offsets = np.asarray(lists.offsets)
        _, code = np.unique(np.asarray(lists.flatten()), return_inverse=True)
        size = np.diff(offsets := offsets - offsets[0])
        root = np.arange(len(node))
        mark = np.zeros(int(code.max()) + 1, np.int32)
        links = []
        for x in np.flatnonzero(chunk == i):
            mark[code[offsets[x] : offsets[x + 1]]] = 1
            shared = np.add.reduceat(mark[code], offsets[:-1])
            mark[code[offsets[x] : offsets[x + 1]]] = 0
            near = (shared >= threshold * (size[x] + size - shared)) & (chunk == j) & (root != root[x])
            for y in np.flatnonzero(near):
                if root[y] != root[x]:
                    links.append((node[min(x, y)], node[max(x, y)]))
                    root[root == root[y]] = root[x]
        return pa.table({"a": pa.array([a for a, _ in links], pa.binary()), "b": pa.array([b for _, b in links], pa.binary())})

    return parts.groupBy("h", "i", "j").applyInArrow(compare, "a binary, b binary")


def links_of(buckets: DataFrame, sets: DataFrame, threshold: float, chunk_items: int = CHUNK_ITEMS) -> DataFrame:
    """``(a, b)``: links that connect all nodes of ``buckets (h, node)`` that links connect."""
    star = staged(_star(buckets), "star")
    near = staged(_similar(star.select("a", "b").distinct(), sets, threshold), "links")
    failed = star.join(near, ["a", "b"], "left_anti").select("h").distinct()
    members = buckets.join(failed, "h").join(sets, "node")
    sizes = members.groupBy("h").agg(
        F.sum(F.size("items")).alias("n_items"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members")
    )
    # Several bands often have the same members: one of these buckets stands for all.
    once = sizes.groupBy("members").agg(F.min(F.struct("h", "n_items")).alias("x")).select("x.*")
    once = staged(once.withColumn("chunks", F.ceil(F.col("n_items") / chunk_items).cast("int")), "open")
    own = buckets.join(once, "h").withColumn("chunk", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("chunks")).cast("int"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    parts = own.join(sets, "node").select(
        "h", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "node", "items"
    )
    return near.union(staged(_compared(parts, threshold), "links"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8, size: int = 5,
                    bands: int = 40, band_rows: int = 6, counted: bool = False) -> DataFrame:
    """``(key, text_hash, node, class_id, class_size, kept)``, one row for each row of ``docs``.

    ``class_size`` counts rows; ``kept`` marks one row of each class, one with the smallest id.
    ``counted`` weighs each run by its occurrences instead of once.
    """
    docs = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    sketched = docs.select("id", F.xxhash64("text").alias("text_hash"), sketch(F.col("text"), size, bands, band_rows, counted).alias("s"))
    drawn = staged(
        sketched.select(F.monotonically_increasing_id().alias("row"), "id", "text_hash", "s.node", "s.bands"), "sketch"
    )
    spread = drawn.filter("node is not null").select(F.explode("bands").alias("h"), "node")
    # Seven bytes tell nodes apart well enough to leave out buckets of one node.
    lead = F.conv(F.hex(F.substring("node", 1, 7)), 16, 10).cast("long")
    shared = (
        spread.select("h", lead.alias("lead")).groupBy("h").agg(F.min("lead").alias("low"), F.max("lead").alias("high"))
        .filter("low <> high").select("h")
    )
    buckets = staged(spread.join(shared, "h").distinct(), "buckets")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash", "row")).alias("first")
    wanted = (
        drawn.join(buckets.select("node").distinct(), "node").groupBy("node").agg(first)
        .select("node", F.col("first.id").alias("wanted_id"), F.col("first.text_hash").alias("wanted_hash"))
    )
    texts = docs.withColumn("text_hash", F.xxhash64("text"))
    chosen = texts.join(wanted, F.col("id").eqNullSafe(F.col("wanted_id")) & (F.col("text_hash") == F.col("wanted_hash")), "left_semi")
    sets = staged(
        chosen.select(shingle_sets(F.col("text"), size, counted).alias("s")).select("s.node", "s.items").dropDuplicates(["node"]), "sets"
    )
    label = components(links_of(buckets, sets, threshold))
    placed = drawn.join(label, "node", "left").select("row", "id", "text_hash", "node", F.coalesce("label", "node").alias("label"))
    whole = placed.filter("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("class_size"), first)
    alone = F.col("label").isNull()
    joined = placed.join(whole, "label", "left").select(
        "id", "text_hash", "node", F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("class_id"),
        F.when(alone, 1).otherwise(F.col("class_size")).alias("class_size"),
        (alone | (F.col("first.row") == F.col("row"))).alias("kept"),
    )
    return joined.withColumnRenamed("id", key)
