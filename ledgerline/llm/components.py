"""Connected components of a table of links by alternating large-star and small-star.

Every round is two aggregations to a least neighbour and the joins back, so no node's neighbours
meet in one task: the least neighbour is pre-aggregated, and a hot node is a skewed equi-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.frames import cut


def _large_star(links: DataFrame) -> DataFrame:
    """Connect each node's larger neighbours to the least node around it."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Connect each node and its smaller neighbours to the least of these."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component's name is its least node.

    ``a`` and ``b`` are numbers without nulls; links to oneself and repeated links are harmless, and
    an empty table gives an empty result. The rounds end when a round changes nothing: the links
    are then stars around least nodes. That takes a number of rounds that grows with the logarithm
    of the longest path, whatever the size of the components.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links = cut(links)
    mark = _mark(links)
    while True:
        links = cut(_small_star(_large_star(links)))
        now = _mark(links)
        if now == mark:
            break
        mark = now
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
