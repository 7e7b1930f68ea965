"""Connected components of an edge table by hooking and pointer jumping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut as keep


def components(edges: DataFrame, cut: Callable[[DataFrame], DataFrame] = keep) -> DataFrame:
    """edges (a, b) to (id, root): the smallest id reachable, for every id that has an edge.

    Each round hooks every vertex to its least neighbour, shortens the chains by pointer jumping and contracts the
    edges, so the number of vertices at least halves. Neighbours are reduced by min, map-side first, and never listed.
    cut: writes an intermediate table and reads it back.
    """
    left = cut(edges.select("a", "b").where("a <> b").distinct())
    roots = None
    while True:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = cut(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("root")))
        while True:
            up = parent.select(F.col("id").alias("root"), F.col("root").alias("top"))
            jumped = cut(parent.join(up, "root").select("id", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")))
            moved = jumped.where("moved").isEmpty()
            parent = jumped.select("id", "root")
            if moved:
                break
        if roots is None:
            roots = parent
        else:
            up = parent.select(F.col("id").alias("root"), F.col("root").alias("top"))
            roots = cut(roots.join(up, "root", "left").select("id", F.coalesce("top", "root").alias("root")))
        pa, pb = parent.select(F.col("id").alias("a"), F.col("root").alias("x")), parent.select(F.col("id").alias("b"), F.col("root").alias("y"))
        left = cut(left.join(pa, "a").join(pb, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        if left.isEmpty():
            return roots
