"""Connected components of a link table, by alternating large and small stars.

Every round is an aggregate by node, which combines before its shuffle, and a join of the
links with one row per node, which adaptive execution can split where a node has very
many links. The links of a round are written to the shared folder; only two numbers
per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsieve.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (
        both.join(least, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest one."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = (
        links.join(least, "a")
        .where(F.col("b") != F.col("m"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) to (node, root): the smallest node of its component, the root left out.

    Self links are dropped; repeated links and links in both directions are fine.
    """
    links = written(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = _mark(links)
    while before[0]:
        links = written(_small_star(_large_star(links)), "links")
        after = _mark(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
