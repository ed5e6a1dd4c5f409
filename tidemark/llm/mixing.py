"""Mixing sources to target weights, with DataFrame functions only.

Documents of a source are dealt into blocks by hash.  A source takes ``full`` passes over its
blocks and then a prefix of a random order of them, so that its words are its rounded target:
the block at the end of the prefix is filled document by document, the last of them in part.
Every pass over a block is a unit.  A tree splits the exact number of units of each source
among the output shards: a node's units go to its two halves by a multivariate
hypergeometric draw, one source after another.  A shard's units are a range of the source's
permuted units, so shards draw disjoint blocks; documents are shuffled within their shard.

Blocks grow with the root of the number of documents, so neither a block nor a source's list
of blocks gets large; only the list of sources is taken as a whole.  All draws are hashes:
reruns agree.

Edge cases: a null text has size 0; a null source is a source of its own, the last one.
Sources without words have target 0.  Repeated rows are separate documents.  An empty table
gives an empty table.  Result columns replace columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import staged

WORD = r"[^\x20\x09-\x0D]+"
RESULTS = ["size", "source_size", "target", "taken", "draws"]


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _name(source: Column) -> Column:
    """A source as text that is never null and sorts as sources do."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def _uniform(*parts) -> Column:
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, most: int = 3) -> DataFrame:
    """``(name, source_size, target)`` from ``(name, source_size)``: weights 1, 2, 3, repeating.

    What a source can't take beyond ``most`` times its size is shared by the others; the
    sources that reach their limit are the first ones by limit per weight.
    """
    everyone = Window.partitionBy(F.lit(1))
    ranked = sizes.withColumn("weight", (F.row_number().over(everyone.orderBy("name")) - 1) % 3 + 1)
    ranked = ranked.withColumn("limit", F.col("source_size") * most).withColumn("all_words", F.sum("source_size").over(everyone))
    by_limit = everyone.orderBy(F.col("limit") / F.col("weight"), "name").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("taken_before", F.coalesce(F.sum("limit").over(by_limit), F.lit(0)))
    ranked = ranked.withColumn("weight_left", F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(by_limit), F.lit(0)))
    ranked = ranked.withColumn("level", (F.col("all_words") - F.col("taken_before")) / F.col("weight_left"))
    open_level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.struct("taken_before", "level"))).over(everyone)
    target = F.least(F.col("limit").cast("double"), open_level["level"] * F.col("weight"))
    return ranked.select("name", "source_size", target.alias("target"))


def _log_factorial(n: Column) -> Column:
    small = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(16)])
    x = F.greatest(n, F.lit(16)).cast("double")
    series = (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x)
    return F.when(n < 16, F.element_at(small, (F.least(n, F.lit(15)) + 1).cast("int"))).otherwise(series)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once and named, so that plans stay small."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hypergeometric(u: Column, total: Column, marked: Column, drawn: Column) -> Column:
    """How many of ``marked`` units are among ``drawn`` of ``total``: the quantile ``u``, read outwards from the mode."""

    def bounded(x: Column) -> Column:
        low, high = F.greatest(F.lit(0).cast("long"), x["m"] + x["d"] - x["t"]), F.least(x["m"], x["d"])
        mode = F.least(high, F.greatest(low, F.floor((x["d"] + 1) * (x["m"] + 1) / (x["t"] + 2)).cast("long")))
        return _let(F.struct(*[x[c].alias(c) for c in "utmd"], low.alias("low"), high.alias("high"), mode.alias("mode")), weighed)

    def weighed(x: Column) -> Column:
        t, m, d, k = x["t"], x["m"], x["d"], x["mode"]
        parts = [m, t - m, d, t - d, t, k, m - k, d - k, t - m - d + k]
        signs = [1, 1, 1, 1, -1, -1, -1, -1, -1]
        logs = F.transform(F.array(*parts), _log_factorial)
        mass = F.exp(F.aggregate(F.zip_with(logs, F.array(*[F.lit(s) for s in signs]), lambda a, s: a * s), F.lit(0.0), lambda a, v: a + v))
        share = m / F.greatest(t, F.lit(1).cast("long"))
        width = F.least(x["high"] - x["low"], F.ceil(F.sqrt(d * share * (1 - share)) * 14).cast("long") + 30)
        return _let(F.struct(*[x[c].alias(c) for c in ("u", "t", "m", "d", "low", "high", "mode")], mass.alias("mass"), width.alias("width")), walked)

    def walked(x: Column) -> Column:
        start = F.struct(
            F.when(x["u"] < x["mass"], x["mode"]).alias("found"), *[x["mass"].alias(c) for c in ("mass", "up", "down")]
        )
        steps = F.sequence(F.lit(1).cast("long"), F.greatest(F.lit(1).cast("long"), x["width"]))
        end = F.aggregate(steps, start, lambda acc, i: F.when(acc["found"].isNotNull(), acc).otherwise(step(x, acc, i)))
        return F.coalesce(end["found"], x["mode"])

    def step(x: Column, acc: Column, i: Column) -> Column:
        above, below = x["mode"] + i, x["mode"] - i
        rest = x["t"] - x["m"] - x["d"]
        up = F.when(above <= x["high"], acc["up"] * (x["m"] - above + 1) * (x["d"] - above + 1) / (above * (rest + above).cast("double")))
        down = F.when(below >= x["low"], acc["down"] * (below + 1) * (rest + below + 1) / ((x["m"] - below) * (x["d"] - below).cast("double")))
        return _let(F.struct(F.coalesce(up, F.lit(0.0)).alias("up"), F.coalesce(down, F.lit(0.0)).alias("down")), lambda y: F.struct(
            F.when(x["u"] < acc["mass"] + y["up"], above)
            .when((x["u"] < acc["mass"] + y["up"] + y["down"]) & (below >= x["low"]), below).alias("found"),
            (acc["mass"] + y["up"] + y["down"]).alias("mass"), y["up"].alias("up"), y["down"].alias("down"),
        ))

    return _let(F.struct(u.alias("u"), total.alias("t"), marked.alias("m"), drawn.alias("d")), bounded)


def _halves(node: Column, seed: int) -> Column:
    """The units of each source that go to the first half of a node's shards."""
    total = F.aggregate(node["units"], F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    first = F.round(total * ((node["to"] - node["from"]) / 2).cast("long") / (node["to"] - node["from"])).cast("long")
    start = F.struct(
        total.alias("total"), first.alias("drawn"), F.array().cast("array<struct<name:string,n:bigint>>").alias("out")
    )

    def one(acc: Column, x: Column) -> Column:
        k = hypergeometric(_uniform(F.lit(seed), node["from"], node["to"], x["name"]), acc["total"], x["n"], acc["drawn"])
        return _let(k, lambda k: F.struct(
            (acc["total"] - x["n"]).alias("total"), (acc["drawn"] - k).alias("drawn"),
            F.concat(acc["out"], F.array(F.struct(x["name"].alias("name"), k.alias("n")))).alias("out"),
        ))

    return F.aggregate(node["units"], start, one, lambda acc: acc["out"])


def split_among_shards(units: DataFrame, shards: int, seed: int) -> DataFrame:
    """``(name, shard, n)`` from ``(name, n)``: exact shares of every source's units, by a tree of draws."""
    listed = units.agg(F.array_sort(F.collect_list(F.struct("name", F.col("n").cast("long").alias("n")))).alias("units"))
    nodes = listed.select(F.struct(F.lit(0).alias("from"), F.lit(shards).alias("to"), "units").alias("node"))
    span = shards
    while span > 1:
        node = F.col("node")
        middle = node["from"] + ((node["to"] - node["from"]) / 2).cast("int")
        split = nodes.withColumn("first", _halves(node, seed))
        rest = F.zip_with(node["units"], F.col("first"), lambda a, b: F.struct(a["name"].alias("name"), (a["n"] - b["n"]).alias("n")))
        left = F.struct(node["from"].alias("from"), middle.alias("to"), F.col("first").alias("units"))
        right = F.struct(middle.alias("from"), node["to"].alias("to"), rest.alias("units"))
        parts = F.when(node["to"] - node["from"] > 1, F.array(left, right)).otherwise(F.array(node))
        nodes = staged(split.select(F.explode(parts).alias("node")), "tree")
        span = span - span // 2
    return nodes.select(F.col("node.from").alias("shard"), F.explode("node.units").alias("x")).select("x.name", "shard", "x.n")


def _plan(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """Per block: the source's figures, words of the last pass, and ``draws (pass, shard)``."""
    wanted = targets(blocks.groupBy("name").agg(F.sum("words").alias("source_size")))
    counts = blocks.groupBy("name").agg(F.count(F.lit(1)).alias("n_blocks"))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1).cast("long")
    wanted = staged(
        wanted.join(counts, "name").withColumn("full", full)
        .withColumn("rest", F.round("target").cast("long") - F.col("full") * F.col("source_size")), "targets",
    )
    order = F.xxhash64(F.lit(seed), "name", "block", "pass")
    before = Window.partitionBy("name", "pass").orderBy(order, "block")
    units = (
        blocks.join(wanted, "name").withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full"))))
        .withColumn("place", F.row_number().over(before) - 1 + F.col("pass") * F.col("n_blocks"))
        .withColumn("before", F.coalesce(F.sum("words").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("extra", F.least(F.col("words"), F.greatest(F.lit(0), F.col("rest") - F.col("before"))))
        .filter((F.col("pass") < F.col("full")) | (F.col("extra") > 0))
    )
    units = staged(units, "units")
    shares = split_among_shards(units.groupBy("name").agg(F.count(F.lit(1)).alias("n")), shards, seed)
    upto = Window.partitionBy("name").orderBy("shard")
    ends = shares.withColumn("end", F.sum("n").over(upto)).groupBy("name").agg(F.sort_array(F.collect_list("end")).alias("ends"))
    drawn = units.join(ends, "name").withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("place"))))
    draws = F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("draws")
    last = F.max(F.when(F.col("pass") == F.col("full"), F.col("extra"))).alias("extra")
    dealt = drawn.groupBy("name", "block").agg(draws, last)
    return (
        blocks.join(wanted, "name").join(dealt, ["name", "block"], "left")
        .select("name", "block", "source_size", "target", "full", F.coalesce("extra", F.lit(0)).alias("extra"),
                F.coalesce("draws", F.array().cast("array<struct<pass:bigint,shard:int>>")).alias("draws"))
    )


def mix(docs: DataFrame, size: Column, source: str = "source", key: str = "doc_id", shards: int = 16, seed: int = 29) -> DataFrame:
    """``docs`` with ``size, source_size, target, taken`` and ``draws``: one ``(pass, shard, words)`` per copy taken."""
    kept = [c for c in docs.columns if c not in RESULTS]
    sized = docs.withColumn("size", size).select(*[F.col(f"`{c}`") for c in kept], "size")
    many = math.ceil(math.sqrt(docs.count()))
    sized = sized.withColumn("_name", _name(F.col(f"`{source}`")))
    sized = sized.withColumn("_block", F.pmod(F.xxhash64(F.lit(seed), F.col(key), "_name"), F.lit(max(1, many))))
    blocks = staged(
        sized.groupBy(F.col("_name").alias("name"), F.col("_block").alias("block")).agg(F.sum("size").alias("words")), "blocks"
    )
    plan = staged(_plan(blocks, shards, seed), "plan")
    plan = plan.select(*[F.col(c).alias(f"_{c}") for c in plan.columns])
    order = Window.partitionBy("_name", "_block").orderBy(F.xxhash64(F.lit(seed + 1), F.col(key)), key, "size")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = F.least(F.col("size"), F.greatest(F.lit(0), F.col("_extra") - F.col("_before")))
    words = F.transform("_draws", lambda d: F.struct(
        d["pass"].alias("pass"), d["shard"].alias("shard"), F.when(d["pass"] < F.col("_full"), F.col("size")).otherwise(F.col("_last")).alias("words")))
    return (
        sized.join(plan, ["_name", "_block"]).withColumn("_before", before).withColumn("_last", last)
        .select(
            *[F.col(f"`{c}`") for c in kept], "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
            (F.col("_full") * F.col("size") + F.col("_last")).alias("taken"),
            F.filter(words, lambda d: (d["words"] > 0) | (d["pass"] < F.col("_full"))).alias("draws"),
        )
    )


def mixture(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", shards: int = 16, seed: int = 29) -> DataFrame:
    """The mix itself: a row for every copy taken, in the order of its shard, with ``shard, pass, words``.

    A copy taken in part keeps its first words, joined by single spaces.
    """
    drawn = mix(docs.drop("shard", "pass", "words"), words_of(F.col(text)), source, key, shards, seed)
    copies = drawn.withColumn("_draw", F.explode("draws"))
    part = F.array_join(F.slice(F.regexp_extract_all(F.col(text), F.lit(f"({WORD})"), 1), 1, F.col("_draw.words").cast("int")), " ")
    copies = copies.withColumn(text, F.when(F.col("_draw.words") < F.col("size"), part).otherwise(F.col(text)))
    place = F.xxhash64(F.lit(seed + 2), "_draw.shard", "_draw.pass", key)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in RESULTS]
    return (
        copies.withColumn("_place", place).repartition("_draw.shard", F.pmod("_place", F.lit(64)))
        .sortWithinPartitions("_draw.shard", "_place")
        .select(*kept, F.col("_draw.shard").alias("shard"), F.col("_draw.pass").alias("pass"), F.col("_draw.words").alias("words"))
    )
