"""Connected components of a graph given as links, by alternating stars in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the smallest of the node and its neighbours."""
    both = _both_ways(links)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).where(F.col("a") != F.col("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _open(links: DataFrame) -> DataFrame:
    """The nodes that keep the links (a, b), a > b and each once, from being stars around the smallest node."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    counted = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counted.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))


def components(links: DataFrame) -> DataFrame:
    """For each node of the links (a, b), a written table: (node, root), root being the smallest node that it reaches.

    Every round shortens the paths to the roots, so the rounds grow with the logarithm of the longest path; each
    round's links are written to the shared folder. They are done once no node has two smaller ones, or a smaller one
    and a larger one: then every node is linked to its root alone.
    """
    links = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        links = written(_small_star(_large_star(links)).distinct(), "links")
        if _open(links).isEmpty():
            break
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
