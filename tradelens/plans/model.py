"""Customer lifetime value regression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelens.functions.numeric import half_up, real, scatter
from tradelens.plans.stats import _features
from tradelens.sources.tables import Tables

# --- fixed values ---
INPUTS = ["orders", "aov", "avg_discount", "segment_enc"]
TARGET = "revenue"
TEST_PERCENT = 25
SEED = 42
SINGULAR = 1e-12  # a pivot of the correlation matrix below this leaves no fit


def is_test_row(key: str = "customer_id", percent: int = TEST_PERCENT, seed: int = SEED):
    """A customer's side of the split depends on its key alone."""
    return scatter(key, seed) % 100 < percent


def _moments(data: DataFrame, names: list[str], group: str) -> DataFrame:
    """Per group and side: rows, means, and covariances of all pairs, from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    return data.groupBy(group, "is_test").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(a).alias(f"m_{a}") for a in names],
        *[F.covar_pop(a, b).alias(f"c_{a}_{b}") for a, b in pairs])


def _pooled(moments: DataFrame, names: list[str]) -> DataFrame:
    """One row: the covariances of all training rows from those of the groups."""
    train = moments.where("NOT is_test")
    whole = Window.partitionBy()
    rows = F.sum("n").over(whole)
    away = train.withColumns({f"d_{a}": F.col(f"m_{a}") - F.sum(F.col("n") * F.col(f"m_{a}")).over(whole) / rows
                              for a in names})
    total = F.sum("n")
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    return away.agg(
        total.alias("n"), *[(F.sum(F.col("n") * F.col(f"m_{a}")) / total).alias(f"m_{a}") for a in names],
        *[(F.sum(F.col("n") * (F.col(f"c_{a}_{b}") + F.col(f"d_{a}") * F.col(f"d_{b}"))) / total)
          .alias(f"c_{a}_{b}") for a, b in pairs])


def _solved(pooled: DataFrame, inputs: list[str], target: str) -> DataFrame:
    """b_<input> and b_0 of least squares: the correlation matrix is eliminated row by row.

    Each step is a projection of the one row. A constant input has the coefficient 0; an input that
    depends on others leaves no fit, then the coefficients are NULL.
    """
    def spread(a: str) -> Column:
        return F.sqrt(F.col(f"c_{a}_{a}"))

    every = [*inputs, target]
    size = len(inputs)
    now = pooled.withColumns({
        f"r_{i}_{j}": F.coalesce(F.try_divide(F.col(f"c_{a}_{b}"), spread(a) * spread(b)), F.lit(float(i == j)))
        for i, a in enumerate(every) for j, b in enumerate(every) if i <= j and i < size})
    for k in range(size):
        pivot = F.col(f"r_{k}_{k}")
        now = now.withColumn(f"r_{k}_{k}", F.when(pivot > SINGULAR, pivot))
        now = now.withColumns({
            f"r_{i}_{j}": F.col(f"r_{i}_{j}") - F.col(f"r_{k}_{i}") * F.col(f"r_{k}_{j}") / pivot
            for i in range(k + 1, size) for j in range(i, size + 1)})
    for k in reversed(range(size)):
        rest = [F.col(f"r_{k}_{j}") * F.col(f"s_{j}") for j in range(k + 1, size)]
        top = reduce(lambda a, b: a - b, rest, F.col(f"r_{k}_{size}"))
        now = now.withColumn(f"s_{k}", F.try_divide(top, F.col(f"r_{k}_{k}")))
    constant = [F.col(f"c_{a}_{a}") == 0 for a in inputs]
    now = now.withColumns({
        f"b_{a}": F.when(constant[k], 0.0).otherwise(F.col(f"s_{k}") * spread(target) / spread(a))
        for k, a in enumerate(inputs)})
    fitted = [F.col(f"b_{a}") * F.col(f"m_{a}") for a in inputs]
    return now.withColumn("b_0", reduce(lambda a, b: a - b, fitted, F.col(f"m_{target}")))


def clv_regression(tables: Tables, digits: int = 4) -> DataFrame:
    """Fit and score of revenue on orders, average order value, discount and segment code.

    Revenue is orders times average order value, and both are inputs; the fit flatters itself.
    It is kept because the report it serves is defined so. Few customers or dependent inputs
    leave the model without a fit, then the result is empty.

    One lazy plan with two reads of the customers: moments per segment and side, from which the code
    of a segment (its place in the alphabet) and the coefficients follow, and the score.
    """
    data = _features(tables).where("segment IS NOT NULL").select(
        "segment", is_test_row().alias("is_test"), *[real(c).alias(c) for c in (*INPUTS[:3], TARGET)])
    names = [*INPUTS, TARGET]
    measured = [c for c in names if c != "segment_enc"]
    coded = _moments(data, measured, "segment") \
        .withColumn("code", real(F.dense_rank().over(Window.orderBy("segment")) - 1))
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:] if "segment_enc" in (a, b)]
    coded = coded.withColumns({"m_segment_enc": F.col("code"),
                               **{f"c_{a}_{b}": F.lit(0.0) for a, b in pairs}})
    fit = _solved(_pooled(coded, names), INPUTS, TARGET)
    codes = coded.agg(F.map_from_entries(F.collect_set(F.struct("segment", "code")))).scalar()
    model = fit.select(F.struct("n", *[f"b_{c}" for c in (*INPUTS, "0")])).scalar()

    scored = data.where("is_test").withColumns({"m": model, "of": codes})
    scored = scored.withColumn("segment_enc", F.try_element_at("of", "segment"))
    guess = reduce(lambda a, b: a + b, [F.col(f"m.b_{c}") * F.col(c) for c in INPUTS], F.col("m.b_0"))
    off = F.col(TARGET) - guess
    found = scored.agg(
        F.count(F.lit(1)).alias("test_rows"), F.first("m").alias("m"),
        F.sum(off * off).alias("unexplained"), F.avg(F.abs(off)).alias("mae"),
        (F.var_pop(TARGET) * F.count(TARGET)).alias("spread"))
    found = found.where((F.col("m.n") > len(INPUTS)) & F.col("m.b_0").isNotNull()).select(
        real("m.n").alias("train_rows"), real("test_rows").alias("test_rows"),
        F.coalesce(1 - F.try_divide("unexplained", "spread"), F.lit(float("nan"))).alias("r2"), "mae",
        F.col("m.b_0").alias("intercept"), *[F.col(f"m.b_{c}").alias(f"coef_{c}") for c in INPUTS])
    return found.unpivot([], found.columns, "metric", "value").select(
        "metric", half_up(F.col("value"), digits).alias("value"))
