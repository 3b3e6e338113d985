"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepquarry.plans.runtime import settle


def _least(edges: DataFrame) -> DataFrame:
    """Per node u the least node among u and its neighbours; a hot node is combined before the shuffle."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected ``edges`` (a, b); root is the least node reached.

    Nodes are longs; null ends and loops are ignored. Every round is two joins of
    the edges with one row a node, so no group is gathered in one task, and is
    written to the shared folder. The rounds grow with the logarithm of the nodes.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    e, seen = settle(e, "edges"), None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large.where("u > v").distinct(), "star")
        near = large.join(_least(large), "u")
        small = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(large.groupBy("u").agg(F.min("v").alias("v"))).where("u > v").distinct()
        e = settle(small, "star")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    rooted = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return rooted.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
