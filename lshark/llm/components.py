"""Connected components of an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lshark.llm.common import stage

#: Edges from which the minima of a step are written before they are joined, so
#: that Spark can split a hot node; fewer edges of one node fit a task easily.
SPLIT = 2_000_000


def _large_star(edges: DataFrame, split: bool) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest of its neighbourhood."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    least = stage(least, "least") if split else least
    return (both.where("v > u").join(least, "u").where("v != m")
            .select(F.col("m").alias("a"), F.col("v").alias("b"))).distinct()


def _small_star(edges: DataFrame, split: bool) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them (edges have a < b)."""
    edges = stage(edges, "large") if split else edges
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    least = stage(least, "least") if split else least
    moved = edges.join(least, "b").where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether no node hangs on two, and none that others hang on hangs itself."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(0).alias("hangs")),
                                          F.struct(F.col("b").alias("node"), F.lit(1).alias("hangs"))))).select("col.*")
    return (ends.groupBy("node").agg(F.sum("hangs").alias("k"), F.min("hangs").alias("low"))
            .where("k > 1 OR (k > 0 AND low = 0)").isEmpty())


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of the nodes of undirected edges ``(a, b)``, the
    component being its smallest node.

    Every step is a minimum with a map-side part and a join; a round of two
    steps is written once.  The number of rounds grows with the logarithm of the
    longest chain.  The steps keep what is connected, so they are done once all
    edges form stars.  Nothing but that answer reaches the driver.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = edges.where("a != b").select(low.alias("a"), high.alias("b"))
    count = edges.count()
    split = count > SPLIT
    while True:
        now = stage(_small_star(_large_star(now, split), split), "stars", count)
        if _all_stars(now):
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
