"""Connected components of a large graph by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import stored


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u, v) with u > v."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = (both.where("v > u").join(low, "u")
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    hung = large.join(least, "u").where("v > m").select(F.col("v").alias("u"),
                                                        F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """True if the edges are stars: every u has one v, and no v is a u."""
    sides = edges.select(F.col("u").alias("node"), F.lit(1).alias("child"),
                         F.lit(0).alias("parent")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    ends = sides.groupBy("node").agg(F.sum("child").alias("c"), F.max("parent").alias("p"))
    return ends.where("c > 1 or (c > 0 and p > 0)").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in `links` (a, b); component is the smallest node.

    Each round is written to the shared folder; rounds end when only stars are left, which takes
    about as many rounds as the logarithm of the longest chain.
    """
    edges = stored(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _settled(edges):
        edges = stored(_round(edges), "edges")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))
