"""Connected components of an edge table by alternating large and small stars.

Every round is a handful of joins and partial aggregates on (node, neighbour) rows; a node with very many neighbours is
only ever aggregated with map-side combining or joined from its large side, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.store import materialize


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node of an edge reaches. edges: a, b of one ordered type.

    Loops and repeated edges are allowed; a table without edges gives no rows. Nodes that are their own root are left out.
    """
    greater, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = materialize(edges.filter("a <> b").select(greater, smaller).distinct())
    seen = fingerprint(edges)
    while seen[0]:
        edges = materialize(small_star(large_star(edges)))
        now = fingerprint(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def fingerprint(edges: DataFrame) -> tuple:
    """Number of edges and a sum of their hashes: one row, to see whether a round changed anything."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def large_star(edges: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the smallest of them."""
    edges = edges.filter("a <> b").distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    ties = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return ties.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
