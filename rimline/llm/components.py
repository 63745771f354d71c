"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rimline.llm.common import cut


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one head and no head has another."""
    ends = edges.select(F.col("node").alias("id"), F.lit(1).alias("below")).union(edges.select("head", F.lit(0)))
    # As a node once, or as a head only; any other mixture isn't a star.
    roles = ends.groupBy("id").agg(F.sum("below").alias("below"), F.min("below").alias("least"))
    return roles.where("below > 1 or (below = 1 and least = 0)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node about it."""
    both = edges.union(edges.select(F.col("head").alias("node"), F.col("node").alias("head")))
    least = cut(both.groupBy("node").agg(F.least(F.min("head"), F.first("node")).alias("least")))
    return both.join(least, "node").where("head > node").select(F.col("head").alias("node"), F.col("least").alias("head")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the least of them."""
    least = cut(edges.groupBy("node").agg(F.min("head").alias("least")))
    moved = edges.join(least, "node").where("head <> least").select(F.col("head").alias("node"), F.col("least").alias("head"))
    return moved.union(least.select("node", F.col("least").alias("head"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, head): the least node of its component for every node that is not that itself.

    ``edges`` has columns node and head with head < node. The rounds needed grow with the logarithm
    of the longest path. Both sides of every join are written tables, so Spark can split a hot node.
    """
    edges = cut(edges.select("node", "head").distinct())
    while not _are_stars(edges):
        edges = cut(_small_star(cut(_large_star(edges))))
    return edges
