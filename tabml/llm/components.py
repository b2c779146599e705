"""Connected components of an edge table, by alternating star operations.

Large-star links every larger neighbour of a node to the smallest node next to
it; small-star does so for the smaller neighbours. Both are a grouped minimum
(combined before the shuffle) and a join, so a hub's edges spread over tasks as
a skewed join does. Each round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``edges``; the component is its smallest node.

    Self-loops and rows with a null end are ignored; repeated and reversed
    edges count once; no edges give an empty table.
    """
    now = stored(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                 .where((F.col(a) != F.col(b))).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("b"), F.least("a", "m").alias("m"))
        large = now.join(least, "b").select("a", F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a")
                 .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
                 .select("e.a", F.col("e.m").alias("b")).where("a <> b").distinct())
        now = stored(small, "edges")
        mark, before = _mark(now), mark
        if mark == before:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return roots.union(roots.select("component", "component").distinct())


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free hash sum of an edge set; equal marks mean that nothing changed."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first())
