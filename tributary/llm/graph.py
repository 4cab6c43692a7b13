"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked with the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("u"), F.least("a", "low").alias("low"))
    above = both.where(F.col("b") > F.col("a"))
    return above.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below are linked with the least of these. Every edge has a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "u")
    below = edges.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return below.unionByName(least.select(F.col("u").alias("a"), F.col("low").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes in ``edges`` (a, b: long): the least node of each connected component, itself included.

    Each round is joins and combining aggregates over edges; the number of rounds grows with the logarithm of the longest
    chain. The driver sees two numbers per round. Self-links and repeated links may occur; no edges give no rows.
    """

    def ordered(e: DataFrame) -> DataFrame:
        return e.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    now, mark = materialize(ordered(edges.select("a", "b")), "edges"), None
    while True:
        found = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
        if mark == tuple(found) or not found["n"]:
            break
        mark = tuple(found)
        now = materialize(ordered(_small_star(ordered(_large_star(now)))), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
