"""Exact quantiles by counting: values are never sorted or shuffled as a whole.

A first pass counts the values in logarithmic buckets (a few thousand to the octave) together with
the figures of a summary. Only the buckets that hold a wanted rank are looked at again: cut evenly
into cells while they hold many rows, and value by value in the end. What a pass hands over, a row
for each wanted rank of each group, goes to the driver and enters the next pass as literals; so
groups must be few, like segments.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

SHARP = 4096  # buckets to the octave
CELLS = 1 << 16
FEW = 1 << 20  # rows that are counted value by value


@dataclass(frozen=True)
class Summary:
    """Figures of one group's values."""

    count: int
    mean: float
    deviations: float  # sum of squared deviations from the mean
    least: float
    most: float
    quantiles: tuple[float, ...]


def _bucket(x: Column) -> Column:
    """Grows with the value, zero for zero."""
    octave = F.least(F.greatest(F.log2(F.abs(x)), F.lit(-1100.0)), F.lit(1100.0))
    step = F.floor((octave + 1101.0) * SHARP)
    return F.when(x > 0, step).when(x < 0, -step).otherwise(F.lit(0).cast("bigint"))


def _ranks(total: Column, probs: list[float]) -> Column:
    """The ranks, from 1, that linear interpolation needs."""
    return F.array_distinct(F.array(*[
        (side((total - 1) * F.lit(p)) + 1).cast("bigint") for p in probs for side in (F.floor, F.ceil)]))


def _first_pass(values: DataFrame, group: list[str], probs: list[float]) -> list[Row]:
    """A row for each wanted rank: its bucket, and the group's figures."""
    counted = values.groupBy(*group, _bucket(F.col("_x")).alias("_at")).agg(
        F.count(F.lit(1)).alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi"),
        F.avg("_x").alias("mean"), F.var_pop("_x").alias("spread"))
    every = Window.partitionBy(*group)
    known = counted.select(
        *group, "n", "lo", "hi", "mean", "spread", F.sum("n").over(every.orderBy("_at")).alias("upto"),
        F.sum("n").over(every).alias("count"), F.min("lo").over(every).alias("least"),
        F.max("hi").over(every).alias("most"),
        F.sum(F.col("n") * F.col("mean")).over(every).alias("sum"))
    away = F.col("mean") - F.col("sum") / F.col("count")
    known = known.withColumn("deviations", F.sum(F.col("n") * (F.col("spread") + away * away)).over(every))
    found = known.withColumn("rank", F.explode(_ranks(F.col("count"), probs))) \
        .where(F.col("rank").between(F.col("upto") - F.col("n") + 1, F.col("upto")))
    return found.withColumn("base", F.col("upto") - F.col("n")).drop("mean", "spread", "upto").collect()


def _next_pass(values: DataFrame, by: str | None, open_: list[tuple], evenly: bool) -> dict:
    """For open intervals (group, lo, hi, base, ranks): (group, rank) -> (n, lo, hi, base) inside."""
    x, place, low, step, ranks, bases = F.col("_x"), None, None, None, [], []
    for i, (group, lo, hi, base, wanted) in enumerate(open_):
        here = x.between(F.lit(lo), F.lit(hi))
        if by:
            here &= F.col(by).eqNullSafe(F.lit(group))
        parts = F.lit(i), F.lit(lo), F.lit((hi - lo) / CELLS)
        place, low, step = (F.when(here, v) if old is None else old.when(here, v)
                            for old, v in zip((place, low, step), parts))
        ranks.append(F.array(*[F.lit(r - base).cast("bigint") for r in wanted]))
        bases.append(base)
    cell = F.least(F.floor((x - low) / step), F.lit(CELLS - 1)) if evenly else x
    counted = values.select(place.alias("i"), cell.alias("cell"), "_x").where("i IS NOT NULL") \
        .groupBy("i", "cell").agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("lo"),
                                  F.max("_x").alias("hi"))
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("cell"))
    wanted = F.explode(F.element_at(F.array(*ranks), F.col("i") + 1))
    found = counted.withColumn("upto", upto).withColumn("rank", wanted) \
        .where(F.col("rank").between(F.col("upto") - F.col("n") + 1, F.col("upto")))
    return {(open_[r["i"]][0], r["rank"] + bases[r["i"]]):
            (r["n"], r["lo"], r["hi"], bases[r["i"]] + r["upto"] - r["n"]) for r in found.collect()}


def summaries(df: DataFrame, value: str, probs: list[float], by: str | None = None
              ) -> dict[object, Summary]:
    """Figures and quantiles of every group (of ``None``, without ``by``). NULLs are ignored.

    Two reads of ``df`` unless a bucket holds more than ``FEW`` rows of different values; every
    further one cuts that bucket by ``CELLS``.
    """
    group = [by] if by else []
    values = df.select(*group, F.col(value).cast("double").alias("_x")).where("_x IS NOT NULL")
    first = _first_pass(values, group, probs)
    name = (lambda row: row[by]) if by else (lambda row: None)
    spots = {(name(r), r["rank"]): (r["n"], r["lo"], r["hi"], r["base"]) for r in first}
    while True:
        open_: dict[tuple, list[int]] = {}
        for (group_, rank), (n, lo, hi, base) in spots.items():
            if lo < hi:
                open_.setdefault((group_, lo, hi, base), []).append(rank)
        if not open_:
            break
        most = max(n for n, lo, hi, _ in spots.values() if lo < hi)
        spots |= _next_pass(values, by, [(*k, ranks) for k, ranks in open_.items()], most > FEW)

    def quantile(group_, total: int, p: float) -> float:
        at = (total - 1) * p
        low, high = (spots[group_, side(at) + 1][1] for side in (math.floor, math.ceil))
        return low + (high - low) * (at - math.floor(at))

    return {name(r): Summary(r["count"], r["sum"] / r["count"], r["deviations"], r["least"], r["most"],
                             tuple(quantile(name(r), r["count"], p) for p in probs)) for r in first}


def quantile_bins(df: DataFrame, value: str, bins: int, name: str) -> DataFrame:
    """Bins 1..bins cut at the value's quantiles; a value on an edge stays in the lower bin.

    Repeated edges simply leave bins empty. A NULL value gets NULL.
    """
    found = summaries(df, value, [e / bins for e in range(1, bins)])
    edges = found[None].quantiles if found else ()
    return df.withColumn(name, bin_of(F.col(value).cast("double"), F.array(*map(F.lit, edges))))


def bin_of(value: Column, edges: Column) -> Column:
    """1 + the number of edges below the value."""
    return F.when(value.isNotNull(), F.size(F.filter(edges, lambda edge: edge < value)) + 1)
