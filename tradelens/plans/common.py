"""Frames shared by several analyses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tradelens.functions.numeric import mean, total
from tradelens.sources.tables import Tables

DELIVERED = "Delivered"
RETURNED = "Returned"
CANCELLED = "Cancelled"
FULFILLED = [DELIVERED, RETURNED]


def whole() -> WindowSpec:
    """All rows of an already aggregated, small frame."""
    return Window.partitionBy()


def orders_in(tables: Tables, statuses: list[str], *columns: str) -> DataFrame:
    return tables.orders(*columns, statuses=statuses)


def delivered(tables: Tables, *columns: str) -> DataFrame:
    return orders_in(tables, [DELIVERED], *columns)


def order_count() -> Column:
    """Orders in a frame that has one row per order; order_id is its declared key."""
    return F.count(F.lit(1))


def order_value(orders: DataFrame, *keys: str, names=("orders", "revenue", "aov")) -> DataFrame:
    """Order count, revenue and average value per key, the core of most reports."""
    count, revenue, aov = names
    return orders.groupBy(*keys).agg(
        order_count().alias(count), total("total_amount").alias(revenue),
        mean("total_amount").alias(aov))


def customer_value(tables: Tables, *extra: Column) -> DataFrame:
    """Delivered orders per customer: count, exact spend, last order."""
    return delivered(tables, "customer_id", "order_date", "total_amount", "discount_pct") \
        .groupBy("customer_id").agg(
            order_count().alias("orders"), F.sum("total_amount").alias("spent"),
            F.max("order_date").alias("last_order_date"), *extra)


def sold_lines(tables: Tables, *columns: str, statuses: list[str] | None = None) -> DataFrame:
    """Order lines of delivered (or other) orders. One shuffle of the lines, on order_id."""
    kept = orders_in(tables, statuses or [DELIVERED], "order_id")
    return tables.order_items("order_id", *columns).join(kept, "order_id")


LINE_MEASURES = ["quantity", "unit_price", "line_revenue"]


def product_sales(tables: Tables) -> DataFrame:
    """Delivered sales per product, summed before the product columns are joined on."""
    return (sold_lines(tables, "product_id", *LINE_MEASURES)
            .groupBy("product_id").agg(
                F.sum("quantity").alias("units"), F.sum("line_revenue").alias("revenue"),
                F.sum("unit_price").alias("price_sum"), F.count("unit_price").alias("prices")))


def category_sales(tables: Tables) -> DataFrame:
    """Delivered sales per category with exact revenue and cost.

    Summed per (category, order) first: then the number of orders is a plain count, and a
    category with very many lines is shared out by order. The products come before the orders, so
    that the join with the orders has already dealt the lines as that sum needs them.
    """
    products = tables.products("product_id", "category", "cost_price")
    lines = tables.order_items("order_id", "product_id", *LINE_MEASURES) \
        .join(products, "product_id").join(delivered(tables, "order_id"), "order_id")
    per_order = lines.groupBy("category", "order_id").agg(
        F.sum("quantity").alias("units"), F.sum("line_revenue").alias("revenue"),
        F.sum(F.col("quantity") * F.col("cost_price")).alias("cost"),
        F.sum("unit_price").alias("price_sum"), F.count("unit_price").alias("prices"))
    return per_order.groupBy("category").agg(
        F.count("order_id").alias("orders"), F.sum("units").alias("units"),
        F.sum("revenue").alias("revenue"), F.sum("cost").alias("cost"),
        F.try_divide(F.sum("price_sum"), F.sum("prices")).alias("price"))
