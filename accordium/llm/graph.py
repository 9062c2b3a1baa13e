"""Connected components over an edge table of longs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the least node that can be reached.

    Large-star and small-star rounds: each is two joins on the node, which adaptive execution splits where a node is hot, so
    that no node's neighbours come together in one task. Every round is written to the shared folder.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "edges")

    def same(e: DataFrame) -> tuple:
        """Number and two order-free checksums of distinct edges: equal where the edges are."""
        parts = [F.xxhash64("a", "b"), F.xxhash64("b", "a", F.lit(1))]
        return tuple(e.agg(F.count(F.lit(1)), *(F.sum(h.cast("decimal(20,0)")) for h in parts)).first())

    now = same(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).distinct()
        small = written(small, "edges")
        new = same(small)
        if new == now:
            break
        edges, now = small, new
    return small.select(F.col("a").alias("node"), F.col("b").alias("root")).union(small.select("b", "b").distinct())
