"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm.common import cut, release


def _downward(a: str, b: str) -> list:
    return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``label``, the smallest id reachable, of all ids that are linked and not the smallest.

    Alternating large and small stars: each step moves the links of a node to the smallest of its
    neighbours, until every component is a star about its smallest id. The number of steps grows with
    the logarithm of the size. Minima are aggregated before the shuffle, and the table of the large
    stars' minima is a stored one, so that a node with very many links can be split in the join.

    Ids are non-null integers. Links to oneself are ignored; repeated links count once; no links: no rows.
    """
    edges = cut(links.select(*_downward(a, b)).where("u > v").distinct())
    while _unfinished(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        large = cut(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        release(edges, low)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        release(large)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("label"))


def _unfinished(edges: DataFrame) -> bool:
    """Whether a node points to two others, or to one that points on."""
    targets = edges.groupBy("u").agg(F.count("*").alias("n"))
    middles = targets.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
    return bool(targets.where("n > 1").unionByName(middles).take(1))
