"""Counting ordered label pairs inside groups, without forming the pairs of large groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.operators.ordering import HOT, number_within
from tradelens.session import materialise

CHUNK, FAN = 32, 4  # rows of which all pairs are formed; pieces that are held against each other


def _close_pairs(rows: DataFrame, *chunk: str) -> DataFrame:
    """a, b of every two rows of a chunk, in order."""
    labels = F.transform(F.array_sort(F.collect_list(F.struct("o", "label"))), lambda row: row["label"])
    held = rows.groupBy("g", *chunk).agg(labels.alias("labels")).where(F.size("labels") > 1)

    def after(a, i):
        return F.transform(F.slice("labels", i + 2, F.lit(CHUNK)), lambda b: F.struct(a.alias("a"), b.alias("b")))

    return held.select(F.explode(F.flatten(F.transform("labels", after))).alias("p")) \
        .groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n"))


def _far_pairs(counts: DataFrame, size: int) -> DataFrame:
    """Pairs between pieces of ``size`` rows that lie in the same ``FAN`` pieces, from label counts."""
    piece = F.floor(F.col("chunk") * CHUNK / size)
    held = counts.groupBy("g", piece.alias("piece"), "label").agg(F.sum("n").alias("n")) \
        .withColumn("around", F.floor(F.col("piece") / FAN))
    first = held.select("g", "around", F.col("piece").alias("p"), F.col("label").alias("a"), F.col("n").alias("x"))
    second = held.select("g", "around", F.col("piece").alias("q"), F.col("label").alias("b"), F.col("n").alias("y"))
    met = first.join(second, ["g", "around"]).where("p < q")
    return met.groupBy("a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("n"))


def ordered_label_pairs(df: DataFrame, group: str, order: str, label: str, hot: int = HOT) -> DataFrame:
    """For labels (a, b): how many row pairs of the same group have a before b. NULL groups have none.

    A group of n rows has n(n-1)/2 pairs, so a hot group would blow up a self-join. The narrow rows
    are written; groups of up to ``CHUNK`` rows, usually all, give their pairs directly. Larger ones
    are numbered and cut into chunks; beyond a chunk only label counts meet: those of neighbouring
    pieces, level by level, each ``FAN`` times as large. A level's work per row is bounded by the
    pieces and the labels in them, its groups by ``FAN`` pieces, and the number of levels by the
    logarithm of the largest group, one number that goes to the driver.
    """
    rows = materialise(df.where(F.col(group).isNotNull()).select(
        F.col(group).alias("g"), F.col(order).alias("o"), F.col(label).alias("label")))
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("size"))
    most = sizes.agg(F.max("size")).first()[0] or 0
    if most <= CHUNK:
        return _close_pairs(rows)
    large = sizes.where(F.col("size") > CHUNK).select("g")
    numbered = number_within(rows.join(large, "g", "left_semi"), "g", ["o", "label"], "place", hot)
    chunked = materialise(numbered.withColumn("chunk", F.floor((F.col("place") - 1) / CHUNK)))
    counts = materialise(chunked.groupBy("g", "chunk", "label").agg(F.count(F.lit(1)).alias("n")))
    parts, size = [_close_pairs(rows.join(large, "g", "left_anti")), _close_pairs(chunked, "chunk")], CHUNK
    while size < most:
        parts.append(_far_pairs(counts, size))
        size *= FAN
    return reduce(DataFrame.unionByName, parts).groupBy("a", "b").agg(F.sum("n").alias("n"))
