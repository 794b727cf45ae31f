"""Connected components of an undirected graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtable.llm.common import materialize


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one parent and no parent has one."""
    parents = edges.select(F.col("low").alias("high")).distinct()
    chained = edges.join(parents, "high", "left_semi").select("high")
    several = edges.groupBy("high").agg(F.count("*").alias("n")).where("n > 1").select("high")
    return chained.union(several).isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself) instead."""
    both = edges.select("high", "low").union(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy("high").agg(F.min("low").alias("least")).select("high", F.least("high", "least").alias("least"))
    return (both.where("low > high").join(least, "high").select(F.col("low").alias("high"), F.col("least").alias("low"))
            .where("high <> low").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    moved = edges.join(least, "high").select(F.col("low").alias("high"), F.col("least").alias("low")).where("high <> low")
    return moved.union(least.select("high", F.col("least").alias("low"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) of every node of ``edges`` (``a``, ``b``).

    Large stars and small stars take turns until every component is a star around its smallest node.  The
    distance to it halves or better in a round, so a chain of a thousand links takes about ten rounds; a
    large star leaves no more links than it finds.  Links of a node to itself and nulls count for nothing; no
    links give no rows.  Only whether a round was the last reaches the driver.
    """
    edges = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), "links")
    while not _stars(edges):
        large = materialize(_large_star(edges), "large")
        edges = materialize(_small_star(large), "small")
    member = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return member.union(member.select(F.col("component").alias("node"), "component").distinct())
