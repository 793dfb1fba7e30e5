"""Connected components of a graph of links, by alternating star contractions in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node in ``edges`` (a, b: longs): the smallest node of its component.

    Rounds of large and small stars, each staged in the shared folder, until nothing moves; their
    number grows with the logarithm of the longest chain. Only two numbers a round come to the driver.
    """
    now = staged(edges.filter("a <> b").select("a", "b").distinct())
    before = None
    while True:
        now = staged(_small_star(_large_star(now)))
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first()
        if state == before:
            break
        before = state
    pairs = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return pairs.unionByName(pairs.select(F.col("root").alias("node"), "root").distinct())
