"""Connected components of an edge table, by alternating star contractions.

Each round joins every node to the smallest node of its neighbourhood, first
among larger neighbours and then among smaller ones, until nothing changes.
Smallest neighbours are plain ``min`` aggregates, so a node with very many
neighbours is pre-aggregated before its shuffle; its edges meet the minimum in
an inner join that adaptive execution can split.  Every round is staged in the
shared folder, so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.session import stage

MAX_ROUNDS = 60  # a guard against a fault; convergence takes about log2(longest path) rounds


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to the smallest of its neighbourhood."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    return near.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a long, b long)``; component: the smallest node reachable."""
    current = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    for _ in range(MAX_ROUNDS):
        seen = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark or seen[0] == 0:
            roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
        mark = seen
        current = stage(small_star(large_star(current)))
    raise RuntimeError("components did not converge")
