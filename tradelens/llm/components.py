"""Connected components of a graph too large for one machine, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node ties its larger neighbours to the smallest node it sees."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node ties its smaller neighbours, and itself, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """node, component (its smallest node) for every node that has a link to another one.

    Large-star and small-star take turns until the edges no longer change; each turn's edges are
    written to the session's checkpoint folder. Links in either direction, repeated ones, and links
    of a node with itself may occur. A hub's edges are aggregated before they move, and joined in
    parts if they are many.
    """
    edges = materialise(links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = _print(edges)
    while before[0]:
        edges = materialise(_small_star(_large_star(edges)))
        now = _print(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
