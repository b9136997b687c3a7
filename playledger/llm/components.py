"""Connected components by alternating large-star and small-star steps (DataFrame operations only).

Each step is a grouped minimum and a join on the same key: partial aggregation takes care of hubs in the minimum,
adaptive skew splitting in the join.  The number of rounds grows with the logarithm of the longest path.
Only a count and a checksum reach the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge between two different nodes; ``component`` is the least node.

    Direction, repetition, self-loops and edges with a null end don't matter.  No edges: an empty frame."""
    e = edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"), (F.col(a) != F.col(b)).alias("two"))
    e = stored(e.where("two").select("lo", "hi").distinct(), "edges")
    seen = _checksum(e)
    while seen[0]:
        e = stored(_small_star(_large_star(e)), "edges")
        now = _checksum(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(e.select("lo", "lo").distinct())


def _checksum(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("lo"), F.bit_xor(F.xxhash64("lo", "hi"))).first())


def _large_star(e: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least node of its neighbourhood."""
    both = e.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(e.select("hi", "lo"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the least of them."""
    least = e.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = e.join(least, "hi").where("m < lo").select("m", "lo")
    return moved.union(least.select("m", "hi")).toDF("lo", "hi").distinct()
