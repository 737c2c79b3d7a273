"""Connected components of a table of links, by contraction; every step is a join or an aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm._store import release, written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of links (a, b), component being the smallest node that links reach.

    Each round points every node to the smallest of itself and its neighbours, follows that pointer once more, and
    replaces each link by its ends' targets until no link is left. Chains halve at least; a star of any size goes in
    two rounds. Aggregations combine in each task first, and joins on a hot node can be split by AQE.
    """
    links = written(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to"))
        once = written(to, "pointers")
        hop = once.select(F.col("node").alias("to"), F.col("to").alias("target"))
        to = written(once.join(hop, "to").select("node", F.col("target").alias("to")), "pointers")
        before = labels
        if before is None:
            labels = to.select("node", F.col("to").alias("component"))
        else:
            step = to.select(F.col("node").alias("component"), "to")
            labels = before.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        labels = written(labels, "labels")
        ends = links.join(to.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        ends = ends.join(to.select(F.col("node").alias("b"), F.col("to").alias("y")), "b").filter("x <> y")
        rest = written(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        release(once, to, before, links)
        links = rest
    return labels if labels is not None else links.select(F.col("a").alias("node"), F.col("b").alias("component"))
