"""Descriptive and inferential statistics over order values and customers."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelens.functions.numeric import half_up, ratio, real
from tradelens.functions.student_t import t_two_sided
from tradelens.operators.quantiles import Summary, summaries
from tradelens.plans.common import customer_value, delivered
from tradelens.sources.schema import SEGMENTS
from tradelens.session import materialise
from tradelens.sources.tables import Tables

# --- fixed values ---
ALPHA = 0.05
BINS = 40
GRID = 200
LINE_POINTS = 50
FEATURES = ["orders", "revenue", "aov", "avg_discount"]


def _values(tables: Tables) -> DataFrame:
    """The delivered amounts, written once: range, bins and quantiles each read them."""
    return materialise(delivered(tables, "total_amount").select(real("total_amount").alias("x"))
                       .where("x IS NOT NULL"))


def _values_by_segment(tables: Tables, segments: list[str]) -> DataFrame:
    people = tables.customers("customer_id", "segment").where(F.col("segment").isin(segments))
    return materialise(
        delivered(tables, "customer_id", "total_amount").join(people, "customer_id").select(
            "segment", real("total_amount").alias("x")))


NOTHING = Summary(0, None, None, None, None, (None, None, None))


def order_value_describe(tables: Tables) -> DataFrame:
    """One row, from the passes that find the quartiles."""
    values = _values(tables)
    found = summaries(values, "x", [0.25, 0.5, 0.75]).get(None, NOTHING)
    spread = (found.deviations / (found.count - 1)) ** 0.5 if found.count > 1 else None
    figures = [found.count, found.mean, spread, found.least, found.most, *found.quantiles]
    row = values.sparkSession.createDataFrame(
        [tuple(figures)], "count bigint, mean double, std double, min double, max double, "
                          "p25 double, p50 double, p75 double")
    return row.withColumns({n: half_up(F.col(n), 2) for n in ("mean", "std", "p25", "p50", "p75")})


def _place(x: Column, low: Column, width: Column, bins: int) -> Column:
    """The bin of a value; the maximum belongs to the last bin."""
    steps = F.try_divide(x - low, width)
    return F.coalesce(F.least(F.floor(steps), F.lit(bins - 1)), F.lit(0))


def _every_bin(bins: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))


def _equal_width(values: DataFrame, bins: int, **figures: Column) -> DataFrame:
    """Rows per bin over [min, max], empty bins included.

    Two passes: one for the range (and further ``figures`` of all values), one to count.
    """
    summary = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"),
                         F.count("x").alias("total"),
                         *[figure.alias(name) for name, figure in figures.items()])
    summary = summary.withColumn("w", (F.col("hi") - F.col("lo")) / bins)
    scale = summary.select(F.struct("lo", "w")).scalar()
    counted = values.select("x", scale.alias("s")) \
        .groupBy(_place(F.col("x"), F.col("s.lo"), F.col("s.w"), bins).alias("bin")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return summary.where("total > 0").withColumn("bin", F.explode(_every_bin(bins))) \
        .join(counted, "bin", "left").na.fill(0, ["n"])


def order_value_histogram(tables: Tables, bins: int = BINS) -> DataFrame:
    """Counts per bin with mean and median: the passes of the median give the range."""
    values = _values(tables)
    found = summaries(values, "x", [0.5]).get(None)
    every = values.sparkSession.range(1 if found else 0).select(F.explode(_every_bin(bins)).alias("bin"))
    found = found or NOTHING
    low = F.lit(found.least).cast("double")
    width = F.lit(None if found.most is None else (found.most - found.least) / bins).cast("double")
    counted = values.groupBy(_place(F.col("x"), low, width, bins).alias("bin")) \
        .agg(F.count(F.lit(1)).alias("orders"))
    lower = low + F.col("bin") * width
    return every.join(counted, "bin", "left").na.fill(0, ["orders"]).select(
        "bin", half_up(lower, 4).alias("lower"), half_up(lower + width, 4).alias("upper"), "orders",
        half_up(F.lit(found.mean), 2).alias("mean"),
        half_up(F.lit(found.quantiles[0]), 2).alias("median"))


def order_value_density(tables: Tables, bins: int = BINS, grid: int = GRID) -> DataFrame:
    """Gaussian density curve from bin counts, Scott bandwidth; cost is bins x grid points."""
    bars = _equal_width(_values(tables), bins, spread=F.stddev_samp("x"))
    curve = bars.groupBy("lo", "hi", "w", "total", "spread").agg(
        F.collect_list(F.struct("bin", "n")).alias("bars"))
    curve = curve.withColumn(
        "h", F.col("spread") * F.pow(F.col("total").cast("double"), F.lit(-0.2)))
    points = curve.withColumn("point", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.lit(grid - 1).cast("bigint"))))
    points = points.withColumn(
        "x", F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("point") / (grid - 1))

    def add(so_far: Column, bar: Column) -> Column:
        centre = F.col("lo") + (bar["bin"] + 0.5) * F.col("w")
        away = F.try_divide(F.col("x") - centre, F.col("h"))
        return so_far + bar["n"] * F.exp(-0.5 * away * away)

    mass = F.aggregate(F.array_sort("bars"), F.lit(0.0), add)
    density = F.try_divide(mass, F.col("total") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))
    return points.select("point", half_up(F.col("x"), 4).alias("x"),
                         half_up(density, 10).alias("density"))


def order_value_box_by_segment(tables: Tables, segments: list[str] = SEGMENTS) -> DataFrame:
    """Quartiles, whiskers within 1.5 IQR, median notch and outlier count per segment."""
    values = _values_by_segment(tables, segments)
    found = summaries(values, "x", [0.25, 0.5, 0.75], by="segment")
    of = {segment: (q1, q2, q3, q3 - q1) for segment, (q1, q2, q3) in
          ((name, summary.quantiles) for name, summary in found.items())}
    names = ["q1", "median", "q3", "iqr"]
    fenced = values.where(F.col("segment").isin(list(of))).select("segment", "x", *[
        F.coalesce(*[F.when(F.col("segment") == name, four[i]) for name, four in of.items()], F.lit(None))
        .cast("double").alias(column) for i, column in enumerate(names)])
    inside = F.col("x").between(F.col("q1") - 1.5 * F.col("iqr"), F.col("q3") + 1.5 * F.col("iqr"))
    kept = F.when(inside, F.col("x"))
    box = fenced.groupBy("segment", "q1", "median", "q3", "iqr").agg(
        F.count("x").alias("orders"), F.min(kept).alias("whisker_low"),
        F.max(kept).alias("whisker_high"), F.count_if(~inside).alias("outliers"))
    notch = 1.57 * F.col("iqr") / F.sqrt(real("orders"))
    return box.select(
        "segment", "orders", *[half_up(F.col(c), 2).alias(c) for c in ("q1", "median", "q3")],
        "whisker_low", "whisker_high",
        half_up(F.col("median") - notch, 2).alias("notch_low"),
        half_up(F.col("median") + notch, 2).alias("notch_high"), "outliers")


# -- customers ---------------------------------------------------------------------------------

def _features(tables: Tables) -> DataFrame:
    value = customer_value(tables, F.avg("discount_pct").alias("avg_discount"))
    return value.join(tables.customers("customer_id", "segment"), "customer_id").select(
        "customer_id", "orders", real("spent").alias("revenue"),
        ratio("spent", "orders").alias("aov"), "avg_discount", "segment")


def customer_features(tables: Tables) -> DataFrame:
    return _features(tables).select(
        "customer_id", "orders", "revenue", half_up(F.col("aov"), 4).alias("aov"),
        half_up(F.col("avg_discount"), 6).alias("avg_discount"), "segment")


def _pearson(a: Column, b: Column) -> Column:
    """Pearson's r as an aggregate; NULL when either side is constant."""
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.try_divide(F.covar_pop(a, b), spread)


def customer_correlations(tables: Tables) -> DataFrame:
    """Pearson correlations below the diagonal, in long form, from one pass."""
    pairs = [(b, a) for a, b in combinations(FEATURES, 2)]
    labels = [f"{row}|{column}" for row, column in pairs]
    wide = _features(tables).select(*[real(c).alias(c) for c in FEATURES]).agg(
        *[_pearson(*map(F.col, pair)).alias(label) for pair, label in zip(pairs, labels)])
    return wide.unpivot([], labels, "label", "value").select(
        F.split_part("label", F.lit("|"), F.lit(1)).alias("row_feature"),
        F.split_part("label", F.lit("|"), F.lit(2)).alias("column_feature"),
        half_up(F.col("value"), 6).alias("correlation"))


def _fitted(tables: Tables) -> DataFrame:
    orders, revenue = real("orders"), F.col("revenue")
    return _features(tables).agg(
        F.regr_slope(revenue, orders).alias("slope"),
        F.regr_intercept(revenue, orders).alias("intercept"),
        F.regr_r2(revenue, orders).alias("r2"), F.min(orders).alias("lo"),
        F.max(orders).alias("hi"))


def orders_revenue_trend(tables: Tables) -> DataFrame:
    return _fitted(tables).select(half_up(F.col("slope"), 2).alias("slope"),
                                  half_up(F.col("intercept"), 2).alias("intercept"),
                                  half_up(F.col("r2"), 6).alias("r2"))


def orders_revenue_trend_line(tables: Tables, points: int = LINE_POINTS) -> DataFrame:
    """Evenly spaced points on the fitted line."""
    line = _fitted(tables).withColumn("point", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.lit(points - 1).cast("bigint"))))
    x = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("point") / (points - 1)
    return line.select("point", half_up(x, 6).alias("orders"),
                       half_up(F.col("slope") * x + F.col("intercept"), 2).alias("revenue"))


# -- tests -------------------------------------------------------------------------------------

def normality_check(tables: Tables) -> DataFrame:
    """Jarque-Bera over all delivered orders; no sample, so the answer is reproducible."""
    moments = _values(tables).agg(F.count("x").alias("n"), F.skewness("x").alias("skew"),
                                  F.kurtosis("x").alias("excess"))
    skew, excess = F.nanvl("skew", F.lit(None)), F.nanvl("excess", F.lit(None))
    statistic = F.col("n") / 6 * (skew * skew + excess * excess / 4)
    p = F.exp(-statistic / 2)
    return moments.select(
        "n", half_up(statistic, 3).alias("statistic"), half_up(p, 6).alias("p_value"),
        F.when(p < ALPHA, "Not normal").when(p >= ALPHA, "Normal").alias("verdict"))


def _verdict(p: Column) -> Column:
    return F.when(p < ALPHA, "Significant").when(p >= ALPHA, "Not significant")


def _two_samples(values: DataFrame, is_a: Column, is_b: Column) -> DataFrame:
    """Student's t-test with pooled variance, from one aggregate over both samples."""
    a, b = F.when(is_a, F.col("x")), F.when(is_b, F.col("x"))
    sums = values.agg(
        F.count(a).alias("n_a"), F.avg(a).alias("mean_a"), F.var_samp(a).alias("var_a"),
        F.count(b).alias("n_b"), F.avg(b).alias("mean_b"), F.var_samp(b).alias("var_b"))
    free = real(F.col("n_a") + F.col("n_b") - 2)
    pooled = F.try_divide((F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b"),
                          free)
    error = F.sqrt(pooled * (F.try_divide(F.lit(1.0), F.col("n_a"))
                             + F.try_divide(F.lit(1.0), F.col("n_b"))))
    tested = sums.withColumn("t", F.try_divide(F.col("mean_a") - F.col("mean_b"), error)) \
        .withColumn("p", t_two_sided(F.col("t"), free))
    return tested.select(
        "n_a", "n_b", half_up(F.col("mean_a"), 2).alias("mean_a"),
        half_up(F.col("mean_b"), 2).alias("mean_b"), half_up(F.col("t"), 6).alias("t_stat"),
        half_up(F.col("p"), 6).alias("p_value"), _verdict(F.col("p")).alias("verdict"))


def segment_ttest(tables: Tables, a: str = "Premium", b: str = "Regular") -> DataFrame:
    return _two_samples(_values_by_segment(tables, [a, b]),
                        F.col("segment") == a, F.col("segment") == b)


def discount_ttest(tables: Tables) -> DataFrame:
    values = delivered(tables, "discount_pct", "total_amount").select(
        "discount_pct", real("total_amount").alias("x"))
    return _two_samples(values, F.col("discount_pct") == 0, F.col("discount_pct") > 0)


def pearson_test(tables: Tables) -> DataFrame:
    """Correlation of a customer's order count with spend; no judgement on its strength."""
    fit = _features(tables).agg(F.count(F.lit(1)).alias("n"),
                                _pearson(real("orders"), F.col("revenue")).alias("r"))
    free = real(F.col("n") - 2)
    t = F.col("r") * F.sqrt(F.try_divide(free, 1 - F.col("r") * F.col("r")))
    certain = (F.abs("r") >= 1) & (free > 0)
    p = F.when(certain, 0.0).otherwise(t_two_sided(t, free))
    return fit.withColumn("p", p).select(
        "n", half_up(F.col("r"), 6).alias("r"), half_up(F.col("p"), 6).alias("p_value"))
