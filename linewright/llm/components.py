"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node points to the node's least neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the least of them (``v < u`` in every edge)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    out = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(u, v)``; the component is its least node.

    No neighbour list is ever gathered: each round is grouped minima and joins, so a hub's
    edges can be spread. Each round is written to the shared folder; the number of rounds
    grows with the logarithm of the largest component. Loops and repeated edges do no harm.
    """
    now = settle(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "edges")
    state = None
    while True:
        now = settle(_small_star(_large_star(now)), "stars")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            break
        state = seen
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
