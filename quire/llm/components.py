"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, salted_join, scratch


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (u, v): root is the smallest node that can be reached.

    Alternates large-star and small-star steps until the edges no longer change. Each step is one
    aggregate and one join over the edges; the edges are cut after each step, so the plan
    doesn't grow and a lost executor costs one step. The hub of a large star is joined in parts. Loops (u, u) are dropped: lone nodes are not
    returned. Repeated edges and either direction are allowed; null ends are dropped.
    """
    with scratch(edges.sparkSession) as brief:
        edges = brief(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        before = None
        while True:
            # Large star: every larger neighbour of u moves to the smallest node around u.
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
            large = salted_join(both, least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            large = brief(large.distinct())
            # Small star: every smaller neighbour of u, and u, move to the smallest of them.
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            moved = salted_join(large, least, "u")
            small = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(moved.select("u", F.col("m").alias("v")))
            edges = brief(small.where("u <> v").distinct())
            state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
            if state == before:
                return cut(edges.select(F.col("u").alias("node"), F.col("v").alias("root")))
            before = state
