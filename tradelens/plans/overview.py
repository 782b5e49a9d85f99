"""Sales overview: status, category, payment, channel, headline figures, margins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.functions.labels import discount_band
from tradelens.functions.numeric import half_up, mean, money, percent, ratio, total
from tradelens.plans.common import (
    CANCELLED, DELIVERED, FULFILLED, RETURNED, category_sales, customer_value, delivered,
    order_count, order_value, orders_in, product_sales, whole,
)
from tradelens.sources.tables import Tables

# --- fixed value: categories below this margin percentage are flagged ---
LOW_MARGIN_PCT = 35


def orders_by_status(tables: Tables) -> DataFrame:
    counted = tables.orders("status").groupBy("status").agg(order_count().alias("order_count"))
    share = percent("order_count", F.sum("order_count").over(whole()), 1)
    return counted.withColumn("pct", share).orderBy(F.desc("order_count"), "status")


def status_counts(tables: Tables) -> DataFrame:
    return (tables.orders("status").where("status IS NOT NULL").groupBy("status")
            .agg(order_count().alias("count")).orderBy(F.desc("count"), "status"))


def revenue_by_category(tables: Tables) -> DataFrame:
    return category_sales(tables).select(
        "category", "orders", F.col("units").alias("units_sold"),
        money("revenue").alias("total_revenue"), half_up(F.col("price"), 2).alias("avg_price"),
    ).orderBy(F.desc("total_revenue"), "category")


def customers_by_segment_state(tables: Tables, limit: int = 20) -> DataFrame:
    return (tables.customers("segment", "state").groupBy("segment", "state")
            .agg(F.count(F.lit(1)).alias("customers"))
            .orderBy(F.desc("customers"), "segment", "state").limit(limit))


def payment_mode_summary(tables: Tables) -> DataFrame:
    """Every order that was not cancelled."""
    kept = tables.orders("payment_mode", "total_amount", "status") \
        .where(F.col("status") != CANCELLED)
    return order_value(kept, "payment_mode",
                       names=("order_count", "total_gmv", "avg_order_value")) \
        .orderBy(F.desc("total_gmv"), "payment_mode")


def channel_summary(tables: Tables) -> DataFrame:
    return order_value(delivered(tables, "channel", "total_amount"), "channel")


def _orders_with_lines(tables: Tables) -> DataFrame:
    """Delivered orders next to the number and units of their lines; one row per order."""
    per_order = tables.order_items("order_id", "quantity").groupBy("order_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units"))
    return delivered(tables, "order_id", "customer_id", "total_amount") \
        .join(per_order, "order_id", "left")


def _kpis(orders: DataFrame, weight) -> DataFrame:
    """``weight`` is how often an order's amount counts."""
    per_customer = orders.groupBy("customer_id").agg(
        order_count().alias("orders"), F.sum(F.col("total_amount") * weight).alias("revenue"),
        F.sum(weight).alias("weight"), F.sum("units").alias("units"))
    return per_customer.agg(
        F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        total("revenue").alias("gross_revenue"),
        ratio(F.sum("revenue"), F.sum("weight"), 2).alias("avg_order_value"),
        F.sum("units").cast("double").alias("total_units_sold"),
        ratio(F.sum("revenue"), F.count("customer_id"), 2).alias("revenue_per_customer"))


def kpi_overview(tables: Tables) -> DataFrame:
    """Business totals, every delivered order counted once."""
    return _kpis(_orders_with_lines(tables), F.lit(1))


def kpi_overview_as_written(tables: Tables) -> DataFrame:
    """The same figures with each order's amount counted once per line.

    This is what joining orders to their lines before summing gives; the multiplicity is applied
    as a factor, so the lines are never multiplied out.
    """
    return _kpis(_orders_with_lines(tables).where("lines IS NOT NULL"), F.col("lines"))


def gross_margin(tables: Tables) -> DataFrame:
    sold = product_sales(tables).join(tables.products("product_id", "cost_price"), "product_id")
    sums = sold.agg(F.sum("revenue").alias("r"),
                    F.sum(F.col("units") * F.col("cost_price")).alias("c"))
    profit = F.col("r") - F.col("c")
    return sums.select(
        money("r").alias("revenue"), money("c").alias("cogs"),
        money(profit).alias("gross_profit"), percent(profit, "r", 1).alias("gross_margin_pct"))


def return_rate(tables: Tables) -> DataFrame:
    """Recorded returns against delivered and returned orders together."""
    per_order = tables.returns("order_id", "return_id").groupBy("order_id") \
        .agg(F.count("return_id").alias("returns"))
    sums = orders_in(tables, FULFILLED, "order_id").join(per_order, "order_id", "left").agg(
        order_count().alias("delivered_orders"),
        F.coalesce(F.sum("returns"), F.lit(0)).alias("returned_orders"))
    return sums.withColumn("return_rate_pct", percent("returned_orders", "delivered_orders", 2))


def clv_by_segment(tables: Tables) -> DataFrame:
    joined = customer_value(tables).join(tables.customers("customer_id", "segment"), "customer_id")
    return joined.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"), mean("orders", 1).alias("avg_orders"),
        mean("spent").alias("avg_clv"), money(F.max("spent")).alias("max_clv"),
    ).orderBy(F.desc("avg_clv"), "segment")


def discount_bands(tables: Tables) -> DataFrame:
    orders = delivered(tables, "discount_pct", "total_amount")
    banded = orders.withColumn("discount_band", discount_band(F.col("discount_pct")))
    return order_value(banded, "discount_band",
                       names=("orders", "total_revenue", "avg_order_value")) \
        .orderBy(F.desc("total_revenue"), "discount_band")


_HEADLINE = ["total_revenue", "total_orders", "avg_order_value", "unique_customers",
             "cancellation_pct", "return_pct"]


def _headline(tables: Tables) -> DataFrame:
    """One pass over the orders, summed per customer so that customers need no distinct count."""
    orders = tables.orders("customer_id", "status", "total_amount", "discount_pct")
    done = F.col("status") == DELIVERED
    discount = F.when(done, F.col("discount_pct"))
    per_customer = orders.groupBy("customer_id").agg(
        order_count().alias("n"), F.count_if(done).alias("orders"),
        F.sum(F.when(done, F.col("total_amount"))).alias("revenue"),
        F.count_if(F.col("status") == CANCELLED).alias("cancelled"),
        F.count_if(F.col("status") == RETURNED).alias("returned"),
        F.sum(discount).alias("discount"), F.count(discount).alias("discounts"))
    return per_customer.agg(
        total("revenue").alias("total_revenue"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
        ratio(F.sum("revenue"), F.sum("orders"), 2).alias("avg_order_value"),
        F.count(F.when(F.col("orders") > 0, F.col("customer_id"))).alias("unique_customers"),
        percent(F.sum("cancelled"), F.sum("n"), 4).alias("cancellation_pct"),
        percent(F.sum("returned"), F.sum("n"), 4).alias("return_pct"),
        percent(F.sum("discount"), F.sum("discounts"), 4).alias("avg_discount_pct"))


def headline_stats(tables: Tables) -> DataFrame:
    """Delivered revenue figures, and status rates over all orders."""
    return _headline(tables).select(*_HEADLINE)


def revenue_by_segment(tables: Tables) -> DataFrame:
    """Summed per customer first, so a busy customer is one row when segments are joined on."""
    joined = customer_value(tables).join(tables.customers("customer_id", "segment"), "customer_id")
    return joined.where("segment IS NOT NULL").groupBy("segment").agg(
        total("spent").alias("total_revenue"),
        ratio(F.sum("spent"), F.sum("orders"), 2).alias("avg_order"),
        F.sum("orders").alias("orders"))


def category_margin(tables: Tables) -> DataFrame:
    sold = category_sales(tables)
    profit = F.col("revenue") - F.col("cost")
    raw = ratio(profit, "revenue", scale=100.0)
    return sold.select(
        "category", money("revenue").alias("revenue"), money(profit).alias("profit"),
        half_up(raw, 4).alias("margin_pct"), (raw < LOW_MARGIN_PCT).alias("below_target"),
        half_up(F.avg(raw).over(whole()), 4).alias("avg_margin_pct"),
    ).orderBy("revenue", "category")


def category_performance(tables: Tables) -> DataFrame:
    profit = F.col("revenue") - F.col("cost")
    return category_sales(tables).select(
        "category", "orders", "units", money("revenue").alias("revenue"),
        money(profit).alias("profit"), half_up(F.col("price"), 2).alias("avg_price"),
        ratio(profit, "revenue", 6).alias("margin"),
        ratio("revenue", F.sum("revenue").over(whole()), 6).alias("revenue_share"),
    ).orderBy(F.desc("revenue"), "category")


def payment_channel_matrix(tables: Tables, channels: list[str] | None = None) -> DataFrame:
    """Orders per payment mode and channel; without a list, every channel gets a column."""
    orders = delivered(tables, "payment_mode", "channel")
    counted = orders.groupBy("payment_mode").pivot("channel", channels)
    return counted.agg(F.count(F.lit(1))).na.fill(0)


def revenue_by_payment(tables: Tables) -> DataFrame:
    return (delivered(tables, "payment_mode", "total_amount").groupBy("payment_mode")
            .agg(total("total_amount").alias("revenue"))
            .orderBy(F.desc("revenue"), "payment_mode"))


def dashboard_kpis(tables: Tables) -> DataFrame:
    """The summary page's tiles; the margin is computed, not assumed."""
    margin = gross_margin(tables).select("gross_margin_pct").scalar()
    return _headline(tables).withColumn("gross_margin_pct", margin)


def state_sales(tables: Tables) -> DataFrame:
    """Delivered sales per state; orders without a state are a group of their own."""
    per_customer = delivered(tables, "state", "customer_id", "total_amount") \
        .groupBy("state", "customer_id") \
        .agg(order_count().alias("n"), F.sum("total_amount").alias("spent"))
    return per_customer.groupBy("state").agg(
        F.sum("n").alias("orders"), F.sum("spent").alias("spent"),
        F.count("customer_id").alias("customers"))


def state_analysis(tables: Tables, top: int | None = None) -> DataFrame:
    """Delivered sales per known state with revenue share and the heat value of its cell."""
    states = state_sales(tables).where("state IS NOT NULL")
    heat = 200 - 150 * ratio("spent", F.max("spent").over(whole()))
    report = states.select(
        "state", "orders", money("spent").alias("revenue"), "customers",
        ratio("spent", "orders", 2).alias("aov"),
        ratio("spent", F.sum("spent").over(whole()), 6).alias("revenue_share"),
        heat.cast("int").alias("heat")).orderBy(F.desc("revenue"), "state")
    return report if top is None else report.limit(top)
