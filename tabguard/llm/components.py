"""Connected components of a graph given as edges, by alternating star contractions.

Every round joins each edge with the smallest neighbour of one of its ends: larger neighbours move to that
minimum, then smaller ones. Edges never multiply, a node with very many edges is only pre-aggregated and joined
(the join may be split), and the rounds needed grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabguard.llm.common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from the larger node ``a`` to the smaller node ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(others).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node that has an edge and is not the smallest of its component.

    ``edges`` has long columns a and b; loops, repeated and null edges are ignored. Without edges the result is
    empty.
    """
    now = saved(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    mark = None
    while True:
        # An edge set that no longer changes is a set of stars; its size and checksums tell.
        new_mark = now.agg(
            F.count(F.lit(1)),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
            F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")),
        ).first()
        if new_mark[0] == 0 or new_mark == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = new_mark
        now = saved(_small_star(_large_star(now)), "edges")
