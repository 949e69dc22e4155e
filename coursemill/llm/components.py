"""Connected components by alternating large-star and small-star joins, with each round kept in the checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``) but the roots themselves; root: smallest node reachable.

    A round joins links with one minimum per node, so a node with very many links is split like any skewed join.
    """
    edges = _distinct(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    mark = None
    while True:
        found = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (found["n"], found["s"]) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = (found["n"], found["s"])
        edges = _small_star(_large_star(edges))


def _distinct(edges: DataFrame) -> DataFrame:
    return saved(edges.where("u <> v").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the smallest one of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _distinct(moved.union(least.select("u", F.col("m").alias("v"))))
