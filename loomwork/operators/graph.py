"""Connected components over an edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.session import cut


def _least(edges: DataFrame) -> DataFrame:
    """For each node its least neighbour; partial aggregation keeps hot nodes cheap."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node with an edge; component: the smallest node that it reaches.

    ``edges`` needs two orderable columns of one type; direction, repeats and self loops
    don't matter, rows with a null end are ignored. No edges: no rows. Each round shuffles
    the edges by node a constant number of times and never gathers a node's neighbours
    in one place; the number of rounds grows with the logarithm of the longest path.
    """
    now = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v")
    now = cut(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    for _ in range(max_rounds):
        now = cut(_small_star(_large_star(now)))
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
        seen = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
