"""Connected components by alternating stars, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import written


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(a, b)`` links of longs -> ``(node, root)`` for all linked nodes; root is the smallest node.

    Each round links every node's larger neighbours, then its smaller ones, to its smallest
    neighbour; rounds grow with the logarithm of the longest chain. Each round's links are written
    to the shared folder. Self links and repeated links count nothing; no links give no rows.
    """
    links = written(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    state = None
    for _ in range(rounds):
        links = written(_small(_large(links)), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
    raise RuntimeError("components did not settle")


def _large(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a")
    moved = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()
