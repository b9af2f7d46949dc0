"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import stored


def _lowest(links: DataFrame, node: str, other: str) -> DataFrame:
    """For each node the least of itself and its neighbours."""
    return links.groupBy(F.col(node).alias("of")).agg(F.least(F.min(other), F.min(node)).alias("low"))


def _settled(links: DataFrame) -> bool:
    """Whether every node points to one other at most, and those pointed to point nowhere."""
    ends = links.select(F.col("high").alias("node"), F.lit(1).alias("points")).unionByName(links.select(F.col("low").alias("node"), F.lit(0).alias("points")))
    seen = ends.groupBy("node").agg(F.sum("points").alias("out"), F.min("points").alias("least"))
    return seen.filter((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("least") == 0))).isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) of every node in ``links`` (a, b).

    A round connects each node's larger neighbours, then its smaller ones, to the least of them,
    until the links are stars. The number of rounds grows with the logarithm of the longest chain.
    Each round is written to the shared folder, so a lost executor costs at most one round; the
    driver only learns whether any node is left that is no star's.
    """
    high, low = F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")
    now = stored(links.filter(F.col("a") != F.col("b")).select(high, low).distinct(), "links")
    while not _settled(now):
        both = now.select(F.col("high").alias("a"), F.col("low").alias("b")).unionByName(now.select(F.col("low").alias("a"), F.col("high").alias("b")))
        lowest = stored(_lowest(both, "a", "b"), "large-star")
        larger = both.join(lowest, F.col("a") == F.col("of")).filter(F.col("b") > F.col("a")).select(F.col("b").alias("high"), F.col("low"))
        now = stored(larger.distinct(), "links")
        lowest = stored(now.groupBy(F.col("high").alias("of")).agg(F.min("low").alias("lowest")), "small-star")
        smaller = now.join(lowest, F.col("high") == F.col("of"))
        moved = smaller.filter(F.col("low") != F.col("lowest")).select(F.col("low").alias("high"), F.col("lowest").alias("low"))
        now = stored(moved.unionByName(lowest.select(F.col("of").alias("high"), F.col("lowest").alias("low"))).distinct(), "links")
    nodes = now.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return nodes.unionByName(now.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct())
