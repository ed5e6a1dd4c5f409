"""Threshold-scaled fingerprints of documents, with DataFrame functions only.

A document's shingles are its runs of five words (all its words where it has fewer); a shingle's
hash is the first 16 hex digits of its MD5.  The sketch keeps every hash below a fixed fraction
of the hash space, so a long document keeps more of them than a short one and any two sketches
compare over the same part of the space.  So that a short document isn't left without a hash,
the ``least`` smallest ones are kept whatever their size.

Every sketch is complete below its limit: the fraction's end or just behind its last hash, and
without limit where it has fewer than ``least`` hashes.  Two sketches are compared below the
lower of their limits.  Sketches merge: the union of those hashes that lie below the lowest limit
is the sketch of the documents together (:func:`merge`, in rows, since a group has no bound).

The fingerprint is the sketch written as text: the hashes in order, 16 digits each.

Edge cases: a null text counts as empty; a text without words has the empty fingerprint, whose
likeness to another empty one is 1 and to any other 0.  Equal texts have equal fingerprints.
Rows with equal id and text are one document and get equal rows; of texts that share an id the
order is that of their hashes; a null id comes first.  The only document of a table is its own
next one.  Long texts are cut into words once; the work is in proportion to the words.
Result columns replace columns of the same name; no other column is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import staged

WIDTH = 5
DIGITS = 16
#: Parameters of a sketch; both sides of a comparison need the same.
FRACTION = 1 / 16
LEAST = 32

_SPACE = r"[\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _end(fraction: float) -> str:
    return format(min(int(fraction * 16**DIGITS), 16**DIGITS - 1), f"0{DIGITS}x")


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SPACE), lambda w: w != "")


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """Distinct hashes of the runs of ``width`` words, unsorted."""

    def of(ws: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(ws) - width, F.lit(0)))
        # Places behind the last word give nulls, which are left out of the joined text.
        run = lambda i: F.concat_ws(" ", *[F.get(ws, i + k) for k in range(width)])
        hashes = F.transform(starts, lambda i: F.substring(F.md5(run(i).cast("binary")), 1, DIGITS))
        return F.when(F.size(ws) > 0, F.array_distinct(hashes)).otherwise(F.array().cast("array<string>"))

    return _let(words(text), of)


def sketch(text: Column, fraction: float = FRACTION, least: int = LEAST) -> Column:
    """Sorted hashes below the fraction, or the ``least`` smallest ones where those are more."""

    def of(found: Column) -> Column:
        return _let(F.filter(found, lambda h: h < _end(fraction)), lambda low: F.when(
            F.size(low) >= least, F.sort_array(low)).otherwise(F.slice(F.sort_array(found), 1, least)))

    return _let(shingle_hashes(text), of)


def fingerprint(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def packed(hashes: Column) -> Column:
    """The sketch in eight bytes a hash, for the way between tasks."""
    return F.unhex(F.array_join(hashes, ""))


def unpacked(data: Column) -> Column:
    size = DIGITS // 2
    places = F.sequence(F.lit(0), F.greatest((F.length(data) / size).cast("int") - 1, F.lit(0)))
    each = F.transform(places, lambda i: F.lower(F.hex(F.substring(data, i * size + 1, F.lit(size)))))
    return F.when(F.length(data) > 0, each).otherwise(F.array().cast("array<string>"))


def limit(hashes: Column, fraction: float = FRACTION, least: int = LEAST) -> Column:
    """The sketch holds every hash of its document that is smaller, as text, than this."""
    last = F.concat(F.element_at(hashes, -1), F.lit("0"))
    return F.when(F.size(hashes) >= least, F.greatest(F.lit(_end(fraction)), last)).otherwise(F.lit("g"))


def likeness(a: Column, b: Column, fraction: float = FRACTION, least: int = LEAST) -> Column:
    """``(containment, jaccard)``: the estimated share of a's shingles that b has, and of those of either that both have."""
    bound = F.least(limit(a, fraction, least), limit(b, fraction, least))
    sides = F.struct(a.alias("a"), b.alias("b"), bound.alias("bound"))

    def below(x: Column) -> Column:
        return F.struct(F.filter(x["a"], lambda h: h < x["bound"]).alias("a"), F.filter(x["b"], lambda h: h < x["bound"]).alias("b"))

    def counted(x: Column) -> Column:
        return F.struct(F.size(x["a"]).alias("a"), F.size(x["b"]).alias("b"), F.size(F.array_intersect(x["a"], x["b"])).alias("both"))

    def shares(n: Column) -> Column:
        alike = (F.size(a) == 0) & (F.size(b) == 0)
        either = n["a"] + n["b"] - n["both"]
        return F.struct(
            F.when(alike, 1.0).when(n["a"] == 0, 0.0).otherwise(n["both"] / n["a"]).alias("containment"),
            F.when(alike, 1.0).when(either == 0, 0.0).otherwise(n["both"] / either).alias("jaccard"),
        )

    return _let(_let(_let(sides, below), counted), shares)


def merge(sketches: DataFrame, by: list[str], hashes: str = "sketch", fraction: float = FRACTION, least: int = LEAST) -> DataFrame:
    """``by, bound, hash``: the sketch of each group's documents together, a row for every hash.

    A group of any size spreads over all tasks; hashes are made distinct in the map tasks first.
    """
    groups = [F.col(f"`{c}`") for c in by]
    bounds = sketches.groupBy(*groups).agg(F.min(limit(F.col(hashes), fraction, least)).alias("bound"))
    rows = sketches.select(*groups, F.explode(hashes).alias("hash")).distinct()
    return rows.join(bounds, by).where("hash < bound").select(*groups, "bound", "hash")


def successors(docs: DataFrame, key: str, tag: str, size: str) -> DataFrame:
    """``key, tag`` of each document with those of the one before and its size, around the table's end.

    The order is that of key and tag.  Documents are dealt into ranges, neighbours are found
    within a range, and the ends of the ranges meet in a table of a row per range.
    """
    unique = docs.select(key, tag, size).repartitionByRange(key, tag).groupBy(key, tag).agg(F.max(size).alias(size))
    ranged = staged(unique.withColumn("range", F.spark_partition_id()), "order")
    row = F.struct(*[F.col(c) for c in (key, tag, size)])
    ends = ranged.groupBy("range").agg(F.max(row).alias("last"))
    ranges = Window.partitionBy(F.lit(1)).orderBy("range")
    before = ends.select(
        "range", F.coalesce(F.lag("last").over(ranges), F.last("last").over(ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("outer")
    )
    inside = F.lag(row).over(Window.partitionBy("range").orderBy(F.col(key).asc_nulls_first(), tag))
    found = ranged.withColumn("inner", inside).join(before, "range").withColumn("before", F.coalesce("inner", "outer"))
    return found.select(key, tag, *[F.col(f"before.{c}").alias(f"before_{c}") for c in (key, tag, size)])


def _name(key: Column) -> Column:
    """A key as text that is never null, so that joins by it need no other exchange than the removal of copies."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))


def _key(name: Column, kind) -> Column:
    return F.when(name != "", F.substring(name, F.lit(2), F.length(name)).cast(kind))


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text", fraction: float = FRACTION, least: int = LEAST) -> DataFrame:
    """Sketches of each document and of its text with the second half replaced by the next document's beginning.

    Returns ``key, n_chars, edited, sketch, edited_sketch, to_edited, to_next`` (the last two of
    :func:`likeness`).  A text crosses the network once, and at most half of it a second time, to
    the document before.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    docs = docs.select(F.col(f"`{key}`").alias("id"), whole.alias("text"))
    tagged = docs.withColumn("tag", F.xxhash64("text"))
    links = staged(successors(tagged.withColumn("size", F.length("text")), "id", "tag", "size"), "links")
    own = tagged.select(_name(F.col("id")).alias("name"), "tag", "text", packed(sketch(F.col("text"), fraction, least)).alias("own"))

    # Both joins read the same columns of `own` by the same key, so its exchange is made once; the key also removes copies.
    link = links.select(_name(F.col("id")).alias("name"), "tag", _name(F.col("before_id")).alias("to"), "before_tag", "before_size")
    begin = F.substring("text", F.lit(1), F.floor(F.col("before_size") / 2).cast("int"))
    sent = own.join(link, ["name", "tag"]).select(F.col("to").alias("name"), F.col("before_tag").alias("tag"), begin.alias("begin"), F.col("own").alias("next"))
    met = own.join(sent.dropDuplicates(["name", "tag"]), ["name", "tag"])
    size = F.length("text")
    kept = F.substring("text", F.lit(1), (size - F.floor(size / 2)).cast("int"))
    met = met.select(
        _key(F.col("name"), docs.schema["id"].dataType).alias("id"), size.cast("long").alias("n_chars"), F.concat(kept, "begin").alias("edited"),
        unpacked(F.col("own")).alias("sketch"), unpacked(F.col("next")).alias("next_sketch"),
    )
    both = met.select("*", sketch(F.col("edited"), fraction, least).alias("edited_sketch"))
    return both.select(
        F.col("id").alias(key), "n_chars", "edited", "sketch", "edited_sketch",
        likeness(F.col("sketch"), F.col("edited_sketch"), fraction, least).alias("to_edited"),
        likeness(F.col("sketch"), F.col("next_sketch"), fraction, least).alias("to_next"),
    )
