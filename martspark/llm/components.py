"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martspark.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node of each node's component. Input: a, b (longs); nodes without edges don't appear.

    Every node ends as a leaf of its component's smallest node. Each step is a
    written table; a node's smallest neighbour is found by a combined
    aggregation, and a hot node's edges are split by the adaptive skew join.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    digest = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    before = digest(now)
    while before[0]:
        # Large star: every larger neighbour of a node moves to the node's smallest neighbour (or the node).
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        large = stored(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        now = stored(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        after = digest(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
