"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest one."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link: root is the smallest node of its component.

    `links` has two bigint columns a and b, in any order, repeated or not. Rounds are logarithmic in the length of
    chains; each is written to the shared folder, which cuts the lineage. A hot node meets its least neighbour in a
    join against one row a node, which adaptive execution splits.
    """
    edges = cut(links.select("a", "b").where("a <> b").distinct(), "links")
    size = None
    while True:
        large = _large_star(edges)
        edges = cut(_small_star(large), "links")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first())
        if now == size:
            break
        size = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
