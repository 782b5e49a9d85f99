"""Ranks, buckets and quantiles cut into pieces against one-task windows and pandas."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradelens.operators import quantiles
from tradelens.operators.ordering import ntile, number_within, quantiles_of, rank_bin, ranks, wide
from tradelens.operators.quantiles import quantile_bins, summaries


def frame(spark, values, groups=None):
    rows = [(i, v, (groups or ["a"] * len(values))[i]) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id bigint, v double, g string")


def tied(n, seed):
    rng = random.Random(seed)
    return [float(rng.choice([1, 1, 1, 2, 3, rng.randint(1, 50)])) for _ in range(n)]


@pytest.mark.parametrize("n", [1, 3, 7, 103, 1000])
@pytest.mark.parametrize("buckets", [5, 7])
def test_ntile(spark, n, buckets):
    df = frame(spark, tied(n, n))
    wide = ntile(df, buckets, ["v", "id"], "b").toPandas().sort_values("id")
    plain = df.withColumn("b", F.ntile(buckets).over(Window.orderBy("v", "id"))) \
        .toPandas().sort_values("id")
    assert wide["b"].tolist() == plain["b"].tolist()
    sizes = plain["b"].value_counts()
    assert sizes.max() - sizes.min() <= 1


def test_ntile_seven_tied_customers(spark):
    got = ntile(frame(spark, [1.0] * 7), 5, ["v", "id"], "b")
    assert [r["b"] for r in got.orderBy("id").collect()] == [1, 1, 2, 2, 3, 4, 5]


@pytest.mark.parametrize("n", [6, 11, 250])
def test_rank_bins_is_qcut_of_first_come_ranks(spark, n):
    values = tied(n, n + 1)
    placed = ranks(frame(spark, values), "id", {"b": F.col("v")})
    got = placed.select("id", rank_bin(F.col("rank"), F.col("total"), 5).alias("b")) \
        .toPandas().sort_values("id")
    expected = pd.qcut(pd.Series(values).rank(method="first"), 5, labels=[1, 2, 3, 4, 5])
    assert got["b"].tolist() == expected.astype(int).tolist()


def test_quantile_bins_is_qcut(spark):
    rng = np.random.default_rng(3)
    values = rng.gamma(2.0, 50.0, 333).round(2).tolist()
    got = quantile_bins(frame(spark, values), "v", 5, "b").toPandas().sort_values("id")
    assert got["b"].tolist() == pd.qcut(values, 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()


def test_quantile_bins_with_repeated_edges(spark):
    got = quantile_bins(frame(spark, [5.0] * 8 + [9.0]), "v", 5, "b").toPandas()
    assert got.set_index("id")["b"].tolist() == [1] * 8 + [5]


@pytest.mark.parametrize("few", [1, 1 << 20])
def test_summaries_by_group(spark, monkeypatch, few):
    """With few = 1 every bucket is cut into cells again and again."""
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "CELLS", 3 if few == 1 else quantiles.CELLS)
    rng = random.Random(9)
    values = tied(300, 9) + [rng.choice([0.0, -5.5, 1e-9, -1e12, 7.25, 7.25 + 1e-9]) for _ in range(300)]
    groups = ["hot" if i % 3 else f"g{i % 4}" for i in range(600)]
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    df = frame(spark, values + [None], groups + ["hot"])
    got = summaries(df, "v", probs, by="g")
    table = pd.DataFrame({"v": values, "g": groups})
    assert set(got) == set(groups)
    for name, found in got.items():
        mine = table[table.g == name].v
        np.testing.assert_allclose(found.quantiles, mine.quantile(probs), rtol=1e-12)
        assert (found.count, found.least, found.most) == (len(mine), mine.min(), mine.max())
        np.testing.assert_allclose([found.mean, found.deviations], [mine.mean(), mine.var(ddof=0) * len(mine)])
    whole = summaries(df, "v", probs)[None]
    np.testing.assert_allclose(whole.quantiles, table.v.quantile(probs), rtol=1e-12)


def test_summaries_of_nothing(spark):
    assert summaries(frame(spark, [None, None]), "v", [0.5]) == {}
    assert quantile_bins(frame(spark, [None, None]), "v", 5, "b").where("b IS NOT NULL").count() == 0


@pytest.mark.parametrize("ranges", [1, 7])
def test_ranks_of_two_columns_with_hot_and_missing_values(spark, monkeypatch, ranges):
    """Half the rows have one value, a tenth have none; several ranges share a value."""
    from tradelens.operators import ordering
    monkeypatch.setattr(ordering, "range_width", lambda *_: ranges)
    rng = random.Random(ranges)
    values = [rng.choice([5.0, 5.0, 5.0, 5.0, 5.0, None, 1.0, float(rng.randint(1, 9)),
                          rng.random() * 10, -1e18]) for _ in range(2000)]
    placed = ranks(frame(spark, values), "id", {"v": F.col("v"), "w": -F.col("id")})
    got = {r["id"]: (r["v"], r["w"]) for r in wide(placed, "id", ["v", "w"], "rank").collect()}
    order = sorted(range(2000), key=lambda i: (values[i] is not None, values[i] or 0.0, i))
    assert got == {i: (place, 2000 - i) for place, i in enumerate(order, 1)}
    probs = [0.1, 0.5, 0.77]
    edges = placed.limit(1).select(quantiles_of(placed, ["v", "w"], probs).alias("e")).first()["e"]
    np.testing.assert_allclose(edges["v"], pd.Series(values, dtype=float).quantile(probs), rtol=1e-12)
    np.testing.assert_allclose(edges["w"], pd.Series(range(-1999, 1)).quantile(probs))


@pytest.mark.parametrize("hot", [0, 400])
@pytest.mark.parametrize("limit", [10, 1000])
def test_number_within(spark, hot, limit):
    rng = random.Random(hot)
    parents = [rng.choice([None, *range(1, 60)]) for _ in range(500)] + [30] * hot
    df = spark.createDataFrame(list(enumerate(parents)), "id bigint, p bigint")
    got = number_within(df, "p", ["id"], "k", hot=limit).collect()
    assert len(got) == len(parents)
    for r in got:
        assert r["k"] == sum(p == r["p"] for p in parents[:r["id"] + 1])


def test_a_hot_parent_is_numbered_by_several_tasks(spark):
    df = spark.range(30_000).selectExpr("id", "CASE WHEN id % 10 < 3 THEN 7 ELSE id END AS p")
    got = number_within(df, "p", ["id"], "k", hot=1000)
    tasks = got.where("p = 7").select(F.spark_partition_id().alias("t")).distinct().count()
    assert tasks > 1
    k = sorted(r["k"] for r in got.where("p = 7").collect())
    assert k == list(range(1, len(k) + 1))
