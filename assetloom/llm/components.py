"""Connected components of a graph given as pairs, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetloom.session import checkpointed


def components(pairs: DataFrame) -> DataFrame:
    """``node, root`` of every node of the pairs (columns ``a``, ``b``); the root is the smallest node.

    Stars of any size stay pairs: a hub's minimum is a grouped minimum with partial sums, and a join with one row per
    node, which adaptive execution splits. Rounds grow with the logarithm of the longest path.
    """
    edges = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    before = None
    while True:
        edges = checkpointed(edges)
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if now == before or now["n"] == 0:
            break
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        parent = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(parent, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = small.unionByName(parent.select("u", F.col("m").alias("v"))).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
