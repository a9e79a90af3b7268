"""Connected components of a graph given as edges, by min-label contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.session import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): the smallest node of its component.

    Alternates two steps until nothing changes: every node hangs its larger neighbours, then
    its smaller ones and itself, under the smallest node it knows. Each step is one grouped
    minimum, combined before the shuffle, and one join, whose hot side adaptive execution can
    split; no neighbour list is ever gathered. The number of rounds grows with the logarithm
    of the longest path. Every round is written to the shared folder.
    """
    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    before = _fingerprint(edges)
    while True:
        # Larger neighbours: both directions, so that every node sees all its neighbours.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        larger = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = larger.filter("a > b").distinct()
        # Smaller neighbours and the node itself.
        least = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b")
        down = least.select("a", F.col("m").alias("b"))
        now = stage(smaller.unionByName(down).distinct())
        after = _fingerprint(now)
        edges = now
        if after == before:  # a forest of stars stays as it is
            break
        before = after
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    top = edges.select(F.col("b").alias("node")).distinct().join(roots.select("node"), "node", "left_anti")
    return stage(roots.unionByName(top.select("node", F.col("node").alias("root"))))


def _fingerprint(edges: DataFrame) -> tuple:
    """Row count and sum of row hashes: two numbers that tell whether the edges changed."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
