"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloft.session import settle


def components(links: DataFrame) -> DataFrame:
    """From links ``a, b`` to ``node, label``: the smallest node that each node but the smallest reaches.

    Alternates large-star and small-star steps until every node hangs on the smallest one; their number
    grows with the logarithm of the longest path. Minima are combined before they are shuffled, so a
    node with very many links sends one row per task. Links stay in tables on shared storage.
    """
    down = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = settle(down.distinct())
    while not _hang_on_roots(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
        down = both.join(least, "a").filter("b > a AND b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        root = down.groupBy("a").agg(F.min("b").alias("root"))
        moved = down.join(root, "a").filter("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
        edges = settle(moved.unionByName(root.withColumnRenamed("root", "b")).distinct())
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def _hang_on_roots(edges: DataFrame) -> bool:
    """Whether each node has one link, down to a node that has none itself."""
    ups = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("root"))
    nodes = ups.unionByName(roots).groupBy("node").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    return nodes.filter("up > 1 OR up = 1 AND root = 1").isEmpty()
