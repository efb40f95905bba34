"""Connected components by alternating large-star and small-star steps.

Each step replaces links by links to the smallest neighbour, so paths shorten by a factor and a
hot node's links collapse to one per neighbour. Links stay in tables: no step sees a whole
component, and each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return (both.join(least, "a").where("b > a and b != least")
            .select(F.col("least").alias("a"), "b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of these neighbours."""
    least = links.groupBy("b").agg(F.min("a").alias("least"))
    smaller = links.join(least, "b").where("a != least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return smaller.union(least.select(F.col("least").alias("a"), "b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is the least node reachable.

    Null ends and links of a node to itself are ignored; order, repetition and direction of links
    don't matter. An empty table gives an empty table.
    """
    current = written(
        links.where("a is not null and b is not null and a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
            F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return current.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
                current.select("a", "a").distinct())
        seen = state
        current = written(_small_star(_large_star(current)), "links")
