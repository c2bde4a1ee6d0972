"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node (the larger ones, or the smaller ones and itself) on its smallest."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # greatest(a, m) is a, but a new column to the planner: both sides of the join get an exchange of their own, and
    # only then can a node with very many neighbours be split at run time
    least = least.select(F.greatest("a", "m").alias("a"), "m")
    hung = both.join(least, "a")
    if large:
        out = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b")


def _settled(edges: DataFrame) -> bool:
    """Does every node hang on one other, and nothing on it?"""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    return ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).where("hangs > 1 or hangs > 0 and holds > 0").isEmpty()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges (a, b) to (node, component): the smallest node that each node reaches.  Nodes without edges are left out.

    Only edges are kept, at most as many as at first; each round is a written table.  The number of rounds follows
    the logarithm of the longest chain.
    """
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(most_rounds):
        if _settled(now):
            break
        now = materialise(_stars(_stars(now, True), False).distinct(), "stars")
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
