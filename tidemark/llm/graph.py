"""Connected components by hooking whole trees under smaller labels, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import discard, staged


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges (a, b)``; the label is the smallest node of the component.

    Labels point at nodes and so form trees.  A step looks up every node's label's label, takes the
    smallest of these among the node's neighbours, and gives it to the node *and* to the node that
    its label points at: not only the node but its whole tree moves under the smaller label, and
    paths are halved.  The steps grow with the logarithm of the number of nodes (19 for a path of
    100 000 nodes in random order, 2 for a star), whatever the diameter.

    Minima are taken in the map tasks first.  Look-ups join a table of unique keys, so a node with
    a third of all edges, or a label with a third of all nodes, is one that the adaptive join
    splits.  An empty table gives an empty table; loops and repeated edges change nothing, edges
    with a null end are dropped.
    """
    edges = edges.select("a", "b").filter("a <> b").distinct()
    both = staged(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
    while True:
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("grand"))
        known = staged(labels.join(jump, "label").select("node", "label", "grand"), "jumps")
        around = both.join(known.select(F.col("node").alias("b"), "grand"), "b").groupBy(F.col("a").alias("node")).agg(F.min("grand").alias("near"))
        offered = staged(known.join(around, "node").select("node", "label", F.least("grand", "near").alias("near")), "offers")
        # A tree moves where one of its nodes was offered a smaller label.
        trees = offered.groupBy("label").agg(F.min("near").alias("tree")).where("tree < label")
        trees = trees.select(F.col("label").alias("node"), "tree")
        lower = F.least("label", "near", "tree")
        moved = staged(offered.join(trees, "node", "left").select("node", lower.alias("label"), (lower < F.col("label")).alias("moved")), "labels")
        more = moved.filter("moved").limit(1).count()
        for df in (known, offered, labels if more else moved):  # of a step only the labels stay
            discard(df)
        if not more:
            discard(both)
            return labels
        labels = moved.select("node", "label")
