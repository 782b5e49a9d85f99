"""Recency, frequency and monetary scores per customer, in the two ways the reports define them.

``rfm_quantile`` gives 5 to the best customers and cuts at quantiles. ``rfm_customers`` uses
NTILE; with ``orientation='as_written'`` bucket 1 is the best, so its "Champions" are the worst
customers, and ``orientation='best_high'`` turns the buckets round. Ties go to the lower key.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelens.functions.labels import LONG_LABELS, SHORT_LABELS, score_label, score_label_six
from tradelens.functions.numeric import half_up, mean, money, percent, real, total
from tradelens.operators.ordering import ntile, ntile_of, quantiles_of, rank_bin, ranks, wide
from tradelens.operators.quantiles import bin_of
from tradelens.plans.common import customer_value
from tradelens.session import materialise
from tradelens.sources.tables import Tables

# --- fixed values: scores run 1..5, recency counts back from this day unless told otherwise ---
BUCKETS = 5
REFERENCE_DATE = date(2025, 1, 1)


def _base(tables: Tables, reference: date) -> DataFrame:
    """One row per customer with a delivered order, written once: every score reads it again."""
    customers = customer_value(tables).select(
        "customer_id", "last_order_date",
        F.datediff(F.lit(reference), "last_order_date").cast("bigint").alias("recency_days"),
        F.col("orders").alias("frequency"), F.col("spent").alias("monetary"))
    return materialise(customers)


def _ntile_scores(base: DataFrame, orientation: str) -> DataFrame:
    """r, f, m by NTILE over recency ascending, frequency and spend descending, ranked in one go."""
    if orientation not in ("as_written", "best_high"):
        raise ValueError(f"unknown orientation: {orientation}")
    placed = ranks(base, "customer_id", {
        "r_score": F.col("recency_days"), "f_score": -F.col("frequency"), "m_score": -F.col("monetary")})
    bucket = ntile_of(F.col("rank"), F.col("total"), BUCKETS)
    if orientation == "best_high":
        bucket = F.lit(BUCKETS + 1) - bucket
    scores = ["r_score", "f_score", "m_score"]
    scored = wide(placed.withColumn("score", bucket), "customer_id", scores, "score")
    return base.join(scored, "customer_id").withColumn(
        "rfm_total", F.col("r_score") + F.col("f_score") + F.col("m_score"))


def rfm_customers(tables: Tables, reference: date = REFERENCE_DATE,
                  orientation: str = "as_written") -> DataFrame:
    base = _base(tables, reference)
    base = base.withColumn("monetary", F.round("monetary", 2))
    scored = _ntile_scores(base, orientation)
    people = tables.customers("customer_id", "first_name", "last_name", "segment")
    cell = F.concat(*[F.col(s).cast("string") for s in ("r_score", "f_score", "m_score")])
    return scored.join(people, "customer_id").select(
        "customer_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"), "segment",
        "last_order_date", "recency_days", "frequency", money("monetary").alias("monetary"),
        "r_score", "f_score", "m_score", "rfm_total", cell.alias("rfm_cell"),
        score_label_six(F.col("rfm_total"), F.col("r_score")).alias("rfm_segment"),
    ).orderBy(F.desc("rfm_total"), "customer_id")


def rfm_segments_ntile(tables: Tables, reference: date = REFERENCE_DATE,
                       orientation: str = "as_written") -> DataFrame:
    scored = _ntile_scores(_base(tables, reference), orientation)
    label = score_label_six(F.col("rfm_total"), F.col("r_score"))
    return scored.groupBy(label.alias("rfm_segment")).agg(
        F.count(F.lit(1)).alias("customers"),
        mean("recency_days", 0).alias("avg_recency"), mean("frequency", 1).alias("avg_frequency"),
        mean("monetary").alias("avg_monetary"), total("monetary").alias("total_revenue"),
    ).orderBy(F.desc("total_revenue"), "rfm_segment")


def _quantile_scores(tables: Tables, reference: date, labels) -> DataFrame:
    """Recency and spend cut at their quantiles, frequency by its ranks; all from one ranking."""
    base = _base(tables, reference)
    placed = ranks(base, "customer_id", {
        "r": F.col("recency_days"), "f": F.col("frequency"), "m": F.col("monetary")})
    probs = [e / BUCKETS for e in range(1, BUCKETS)]
    placed = placed.withColumn("edges", quantiles_of(placed, ["r", "m"], probs))
    by_value = bin_of(F.col("value"), F.try_element_at("edges", F.col("name")))
    by_rank = rank_bin(F.col("rank"), F.col("total"), BUCKETS)
    score = F.when(F.col("name") == "f", by_rank) \
        .when(F.col("name") == "r", F.lit(BUCKETS + 1) - by_value).otherwise(by_value)
    scored = base.join(wide(placed.withColumn("score", score), "customer_id", ["r", "f", "m"], "score"),
                       "customer_id")
    scored = scored.withColumn("rfm_score", F.col("r") + F.col("f") + F.col("m"))
    return scored.withColumn("rfm_segment", score_label(F.col("rfm_score"), labels))


def rfm_quantile(tables: Tables, reference: date = REFERENCE_DATE, labels=SHORT_LABELS) -> DataFrame:
    return _quantile_scores(tables, reference, labels).select(
        "customer_id", F.col("recency_days").alias("recency"), "frequency",
        money("monetary").alias("monetary"), "r", "f", "m", "rfm_score",
        F.col("rfm_segment").alias("segment"))


def _by_segment(tables: Tables, reference: date, labels, *extra: Column):
    scored = _quantile_scores(tables, reference, labels)
    return scored.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"), mean("monetary").alias("avg_monetary"), *extra)


def rfm_segment_summary(tables: Tables, reference: date = REFERENCE_DATE, labels=SHORT_LABELS) -> DataFrame:
    """Customers, their share of all customers, and average spend per group."""
    everyone = F.sum("customers").over(Window.partitionBy())
    return _by_segment(tables, reference, labels).select(
        F.col("rfm_segment").alias("segment"), "customers",
        percent("customers", everyone, 1).alias("customers_pct"), "avg_monetary",
    ).orderBy(F.desc("avg_monetary"), "segment")


def rfm_report(tables: Tables, reference: date = REFERENCE_DATE) -> DataFrame:
    """Customer-level scores with name, city and the long wording of the groups."""
    people = tables.customers("customer_id", "first_name", "last_name", "segment", "city")
    return _quantile_scores(tables, reference, LONG_LABELS) \
        .join(people, "customer_id").select(
            "customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("name"),
            "segment", "city", F.col("recency_days").alias("recency"), "frequency",
            money("monetary").alias("monetary"), "rfm_score", "rfm_segment")


def rfm_segment_pivot(tables: Tables, reference: date = REFERENCE_DATE) -> DataFrame:
    """Count, average lifetime value and average recency per group."""
    recency = half_up(F.avg(real("recency_days")), 1).alias("avg_recency")
    return _by_segment(tables, reference, LONG_LABELS, recency).select(
        "rfm_segment", "customers", F.col("avg_monetary").alias("avg_clv"), "avg_recency")


def customer_kpis(tables: Tables, reference: date = REFERENCE_DATE) -> DataFrame:
    """Customers, Champions and customers at risk of leaving (At Risk or Lost)."""
    scored = _quantile_scores(tables, reference, SHORT_LABELS)
    everyone = tables.customers("customer_id").agg(F.count(F.lit(1))).scalar()
    return scored.agg(
        F.count_if(F.col("rfm_segment") == "Champions").alias("champions"),
        F.count_if(F.col("rfm_segment").isin("At Risk", "Lost")).alias("churn_risk"),
    ).select(everyone.alias("total_customers"), "champions", "churn_risk")


def rfm_scatter(tables: Tables, reference: date = REFERENCE_DATE) -> DataFrame:
    return _quantile_scores(tables, reference, SHORT_LABELS).select(
        "customer_id", "frequency", money("monetary").alias("monetary"), "rfm_segment")


def pareto_share(tables: Tables) -> DataFrame:
    """Revenue share of the top fifth of customers by spend (the first NTILE bucket)."""
    base = _base(tables, REFERENCE_DATE)
    ranked = ntile(base.withColumn("_m", -F.col("monetary")), BUCKETS, ["_m", "customer_id"], "fifth")
    top = F.col("fifth") == 1
    sums = ranked.agg(
        F.count_if(top).alias("top_customers"), F.count(F.lit(1)).alias("customers"),
        F.sum(F.when(top, F.col("monetary"))).alias("t"), F.sum("monetary").alias("a"))
    return sums.select("customers", "top_customers", money("t").alias("top_revenue"),
                       money("a").alias("revenue"), percent("t", "a", 4).alias("top_share_pct"))
