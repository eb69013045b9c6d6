"""Connected components of a graph given as edges between 64-bit nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemine.session import checkpoint


def _star(edges: DataFrame, smaller: bool) -> DataFrame:
    """Hang the neighbours of each node that are larger than it (``smaller``: not larger) on its least neighbour."""
    least = edges.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m")).select("_u", F.least("_u", "_m").alias("m"))
    joined = edges.join(least, F.col("u") == F.col("_u"))
    if smaller:
        hung = joined.select(F.explode(F.array("u", "v")).alias("a"), F.col("m").alias("b"))
    else:
        hung = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return hung.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of ``edges`` (u, v) except the roots; a root is the least node of its component.

    Alternates large-star and small-star steps: each is an aggregation and a join, neighbours are never gathered in a
    row, and the number of edges never grows. Every round ends in a checkpoint, so lineage stays short."""
    now = checkpoint(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), few=True)
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, False).select(F.col("a").alias("u"), F.col("b").alias("v"))
        # every edge now leads from a node to a smaller one
        small = _star(large, True).select(F.col("a").alias("u"), F.col("b").alias("v"))
        now = checkpoint(small, few=True)
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(seen)
