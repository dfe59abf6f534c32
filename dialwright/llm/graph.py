"""Connected components of a graph that no machine has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialwright.llm.common import drop_stored, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Point every larger neighbour of a node at the smallest node around it."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Point a node and its smaller neighbours at the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every node with an edge.

    Alternates large-star and small-star steps until nothing changes; each round
    is two grouped minima and two joins, written to the shared folder, and the
    rounds grow with the logarithm of the longest chain.  Edges are longs; nulls
    and loops are ignored, so nodes that only have loops are not returned.
    """
    spark = edges.sparkSession
    held = stored(
        edges.where(f"`{a}` != `{b}`").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    seen = None
    while True:
        step = stored(_small_star(_large_star(held)), "edges")
        drop_stored(spark, held)
        held = step
        mark = held.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = held.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return held.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
