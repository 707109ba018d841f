"""Connected components of a table of links, by alternating stars.

Large star: every node links its larger neighbours to the smallest node it
knows. Small star: every node links its smaller neighbours and itself to the
smallest of them. Both keep the components and turn them into stars around
their smallest node in a number of rounds that grows with the logarithm of a
component's size. Every step is written to the checkpoint folder; a node's
minimum is a table of its own, so a hub's links are rows of a plain shuffle
join, which Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.llm.common import Scratch


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that is not the smallest
    of its component; root is the smallest. Links of a node to itself count
    for nothing."""
    smaller = links.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).filter("a <> b")
    edges = scratch.write(smaller.select("a", "b").distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = scratch.write(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.write(large, "large")
        least = scratch.write(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        known = large.join(least, "a")
        small = known.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges = scratch.write(small.distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
