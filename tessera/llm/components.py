"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _fingerprint(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges, and for others with a chance of 2 ** -128: one pass, no join."""
    both = F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64(F.lit(1), "v", "u"))
    return tuple(edges.agg(F.count(F.lit(1)), *both).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` for every endpoint of ``edges(a, b)``; component is the smallest id reachable.

    Each round is a pair of grouped minima over the edges, so it takes O(log^2 n) rounds whatever the shape of the
    graph, and a hub's minimum is combined on the map side. The edges of one hub meet its minimum in one task, as a stream
    that is not held. Loops and repeated edges are harmless; edges with a null end are ignored. Empty input gives an
    empty result.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a is not null and b is not null and a <> b").distinct())
    now = _fingerprint(e)
    for _ in range(max_rounds if now[0] else 0):
        # large star: every larger neighbour of u points at the least of u and its neighbours
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m0")).select("u", F.least("u", "m0").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours point at the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("x"), "m").where("x <> m").select(F.col("x").alias("u"), F.col("m").alias("v")).distinct()
        e, before = cut(small), now
        now = _fingerprint(e)
        if now == before:  # a forest of stars is the fixed point: the same edges come back
            break
    else:
        if now[0]:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
