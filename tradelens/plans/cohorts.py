"""Cohort retention, and new against repeat orders."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelens.functions.labels import year_month
from tradelens.functions.numeric import money, percent, ratio
from tradelens.plans.common import delivered, order_count
from tradelens.sources.tables import Tables


def cohort_retention(tables: Tables, limit: int | None = None) -> DataFrame:
    """Customers by month of first order and month of activity; with ``limit`` the first cells only.

    Orders shrink to each customer's set of months in one shuffle; a set never holds more than
    there are months. All of a cohort is active in its own first month, so that cell is the
    cohort's size.
    """
    months = delivered(tables, "customer_id", "order_date").where("order_date IS NOT NULL") \
        .groupBy("customer_id").agg(F.collect_set(F.trunc("order_date", "month")).alias("months"))
    cells = months.select(F.array_min("months").alias("cohort"), F.explode("months").alias("month")) \
        .groupBy("cohort", "month").agg(F.count(F.lit(1)).alias("active_customers"))
    size = F.max(F.when(F.col("month") == F.col("cohort"), F.col("active_customers"))) \
        .over(Window.partitionBy("cohort"))
    report = cells.withColumn("cohort_customers", size).select(
        year_month("cohort").alias("cohort_month"), "cohort_customers",
        year_month("month").alias("order_month"), "active_customers",
        percent("active_customers", "cohort_customers", 1).alias("retention_pct"),
    ).orderBy("cohort_month", "order_month")
    return report if limit is None else report.limit(limit)


def _place_in_time(day: str, key: str) -> Column:
    """One number that orders by day, then by key; unlike a struct it fits a hash aggregate."""
    return F.unix_date(day).cast("decimal(10,0)") * F.lit(Decimal(10) ** 19) \
        + F.col(key).cast("decimal(19,0)")


def new_vs_repeat(tables: Tables) -> DataFrame:
    """First delivered order of each customer against all later ones; same-day ties by order_id.

    One aggregate per customer finds the first order, so a customer with very many orders is
    never sorted in one place.
    """
    orders = delivered(tables, "customer_id", "order_date", "order_id", "total_amount")
    first = F.min_by("total_amount", _place_in_time("order_date", "order_id"))
    per_customer = orders.groupBy("customer_id").agg(
        first.alias("first"), order_count().alias("n"), F.sum("total_amount").alias("spent"))
    sums = per_customer.agg(
        F.count(F.lit(1)).alias("new_n"), F.sum("first").alias("new_sum"),
        F.sum(F.col("n") - 1).alias("rep_n"),
        F.sum(F.col("spent") - F.col("first")).alias("rep_sum"))
    rows = F.explode(F.array(
        F.struct(F.lit("New Customer").alias("customer_type"), F.col("new_n").alias("orders"),
                 F.col("new_sum").alias("amount")),
        F.struct(F.lit("Repeat Customer").alias("customer_type"), F.col("rep_n").alias("orders"),
                 F.col("rep_sum").alias("amount"))))
    return sums.select(rows.alias("r")).select("r.*").where("orders > 0").select(
        "customer_type", "orders", money("amount").alias("revenue"),
        ratio("amount", "orders", 2).alias("aov"))
