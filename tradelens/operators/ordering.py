"""Global order without moving everything into one task.

A window with an order but no partition key sorts the whole table in a single task. Here the rows
are range-sorted and written with their place in the range; a row's rank is that place plus the
sizes of the ranges before, of which there is one row each. Several columns are ranked in one go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelens.session import materialise, range_width, shuffle_width


def ranks(df: DataFrame, key: str, values: dict[str, Column], rows: int | None = None) -> DataFrame:
    """name, key, value, rank, total, nulls: every named value's rows, numbered 1, 2, 3 ...

    Ascending order of (value as a double, key), NULL values first; ``total`` rows, ``nulls`` of
    them without a value. One shuffle of narrow rows, a row for each value; ``df`` is read twice
    (once to find the ranges), so hand over a written table. A value that very many rows have is
    spread over ranges by the key. ``rows`` is the row count of ``df``, if known.
    """
    entries = [F.struct(F.lit(n).alias("name"), v.cast("double").alias("value")) for n, v in values.items()]
    long = df.select(key, F.explode(F.array(*entries)).alias("e")).select(key, "e.name", "e.value")
    rows = df.count() if rows is None else rows
    width = range_width(df.sparkSession, rows * len(values))
    order = ["name", "value", key]
    placed = materialise(long.repartitionByRange(width, *order).sortWithinPartitions(*order)
                         .withColumn("spot", F.monotonically_increasing_id()))
    # That id is the range's number, shifted, plus the place in the range.
    placed = placed.withColumn("part", F.shiftright("spot", 33))
    before = Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("name")
    sizes = placed.groupBy("name", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("spot").alias("low"),
        F.count_if(F.col("value").isNull()).alias("empty"))
    starts = sizes.select(
        "name", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low") + 1).alias("shift"),
        F.sum("n").over(whole).alias("total"), F.sum("empty").over(whole).alias("nulls"))
    return placed.join(starts, ["name", "part"]).select(
        "name", key, "value", (F.col("spot") + F.col("shift")).alias("rank"), "total", "nulls")


def ntile_of(rank: Column, total: Column, buckets: int) -> Column:
    """NTILE(buckets) of a rank."""
    big = F.floor(total / buckets)
    rest = total % buckets
    in_larger = F.ceil(rank / (big + 1))
    after = rest + F.ceil(F.try_divide(rank - rest * (big + 1), big))
    return F.when(rank <= rest * (big + 1), in_larger).otherwise(after).cast("int")


def rank_bin(rank: Column, total: Column, bins: int) -> Column:
    """Bins 1..bins by cutting the ranks 1..n at their equal-width quantiles.

    Rank k falls past edge e when k > 1 + (n - 1) * e / bins; the edge is taken in integers.
    """
    past = [(rank > F.floor((total - 1) * e / bins) + 1).cast("int") for e in range(1, bins)]
    return sum(past, F.lit(1))


def quantiles_of(ranked: DataFrame, names: list[str], probs: list[float]) -> Column:
    """A scalar: for each name the quantiles of its values, interpolated between ranks."""
    def position(p: float) -> Column:
        return (F.col("total") - F.col("nulls") - 1) * F.lit(p)

    def at(spot: Column) -> Column:
        return (spot + F.col("nulls") + 1).cast("bigint")

    wanted = F.array(*[at(side(position(p))) for p in probs for side in (F.floor, F.ceil)])
    hit = ranked.where(F.col("name").isin(names) & F.array_contains(wanted, F.col("rank")))
    found = hit.groupBy("name").agg(
        F.first("total").alias("total"), F.first("nulls").alias("nulls"),
        F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("of"))

    def quantile(p: float) -> Column:
        low, high = (F.try_element_at("of", at(side(position(p)))) for side in (F.floor, F.ceil))
        return low + (high - low) * (position(p) - F.floor(position(p)))

    return found.agg(F.map_from_entries(F.collect_list(F.struct(
        "name", F.array(*map(quantile, probs)))))).scalar()


def wide(scored: DataFrame, key: str, names: list[str], score: str) -> DataFrame:
    """The scores of a key's names side by side."""
    return scored.groupBy(key).agg(*[
        F.max(F.when(F.col("name") == name, F.col(score))).alias(name) for name in names])


def ntile(df: DataFrame, buckets: int, order_by: list[str], name: str) -> DataFrame:
    """Adds NTILE(buckets) over the unique ascending order of a value and a key."""
    value, key = order_by
    placed = ranks(df, key, {name: F.col(value)})
    scored = placed.select(key, ntile_of(F.col("rank"), F.col("total"), buckets).alias(name))
    return df.join(scored, key)


HOT = 2_000_000  # rows of one parent that are still numbered by one task


def number_within(df: DataFrame, parent: str, order_by: list[str], name: str, hot: int = HOT) -> DataFrame:
    """Adds 1, 2, 3 ... within each parent, in the unique order ``order_by``.

    A window per parent: one shuffle and a sort that can spill. Parents with more than ``hot`` rows,
    found by counting, are numbered on two levels instead: their rows are range-sorted and written
    with their place in the range, what each range holds of a parent is added up, and the sum of the
    ranges before is added to the place. At most one parent per ``hot`` rows is such a one, so their
    list and that of their pieces may be broadcast.
    """
    large = materialise(df.groupBy(parent).agg(F.count(F.lit(1)).alias("_n"))
                        .where(F.col("_n") > hot).select(F.col(parent).alias("_large")))
    within = Window.partitionBy(parent).orderBy(*order_by)
    if large.isEmpty():
        return df.withColumn(name, F.row_number().over(within).cast("bigint"))
    is_large = F.col(parent).eqNullSafe(F.col("_large"))
    usual = df.join(F.broadcast(large), is_large, "left_anti") \
        .withColumn(name, F.row_number().over(within).cast("bigint"))

    order = [parent, *order_by]
    rows = df.join(F.broadcast(large), is_large, "left_semi")
    placed = materialise(rows.repartitionByRange(shuffle_width(df.sparkSession), *order)
                         .sortWithinPartitions(*order)
                         .withColumn("_spot", F.monotonically_increasing_id())) \
        .withColumn("_part", F.shiftright("_spot", 33))
    pieces = placed.groupBy(F.col(parent).alias("_of"), F.col("_part").alias("_in")).agg(
        F.min("_spot").alias("_low"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_of").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select("_of", "_in", (F.coalesce(F.sum("_n").over(before), F.lit(0))
                                          - F.col("_low") + 1).alias("_shift"))
    here = F.col(parent).eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_in"))
    numbered = placed.join(F.broadcast(starts), here) \
        .withColumn(name, F.col("_spot") + F.col("_shift")).select(*usual.columns)
    return usual.unionByName(numbered)
