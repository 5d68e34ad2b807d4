"""Connected components of an undirected edge table: alternating large-star and small-star steps.

Each step takes minima per node (combined before the shuffle), writes them to the shared folder, and joins them back, so
that a node with very many links is only ever the streamed side of a join that adaptive execution can split. The number
of steps grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokscope.llm.common import settle


def _large_star(e: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node that the node sees."""
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m")))
    return both.filter("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. ``e`` has u > v."""
    least = settle(e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m"))
    moved = e.join(least, F.col("u") == F.col("k")).filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("k").alias("u"), F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) for every node of ``edges`` (columns a, b; any order, loops allowed)."""
    e = settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        e = settle(_small_star(_large_star(e).distinct()).distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
