"""Connected components of a distributed edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spectrel.operators.shared import written


def _unsettled(edges: DataFrame) -> bool:
    """Whether some node has two smaller neighbours, or one that has a smaller neighbour itself."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return nodes.where("up > 1 OR (up > 0 AND down > 0)").limit(1).count() > 0


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (bigint a, b): root is the smallest node of its component.

    Each round aggregates and joins on one node, with partial aggregation before the shuffle; the edges stay distributed.
    Rounds grow with the logarithm of the longest chain; edges that are stars already take none. No edge: no row.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    edges = written(edges.where("a <> b").select(a.alias("a"), b.alias("b")).distinct(), "edges")
    while _unsettled(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(least.select("a", F.col("m").alias("b")).union(small).distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
    ).groupBy("node").agg(F.min("root").alias("root"))
