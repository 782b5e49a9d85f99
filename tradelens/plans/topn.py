"""Top-N reports, product and return measures, concentration of revenue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelens.functions.numeric import half_up, money, percent, ratio
from tradelens.plans.common import (
    FULFILLED, category_sales, customer_value, orders_in, product_sales, whole,
)
from tradelens.plans.overview import (
    category_margin, channel_summary, return_rate, state_analysis, state_sales,
)
from tradelens.session import grouped_width
from tradelens.sources.tables import Tables


def top_products_revenue(tables: Tables, limit: int = 10) -> DataFrame:
    """The top rows are picked before the product names are looked up."""
    ranked = product_sales(tables).withColumn("total", F.round("revenue", 2)) \
        .orderBy(F.desc("total"), "product_id").limit(limit)
    names = tables.products("product_id", "product_name", "category", "brand")
    return ranked.join(names, "product_id").select(
        "product_id", "product_name", "category", "brand",
        F.col("units").alias("units_sold"), money("revenue").alias("revenue"),
        half_up(F.try_divide("price_sum", "prices"), 2).alias("avg_price"),
    ).orderBy(F.desc("revenue"), "product_id")


def top_states(tables: Tables, limit: int = 5) -> DataFrame:
    return state_sales(tables).select(
        "state", "customers", "orders", money("spent").alias("revenue"),
        ratio("spent", "orders", 2).alias("aov")).orderBy(F.desc("revenue"), "state").limit(limit)


def top_customers(tables: Tables, limit: int = 10) -> DataFrame:
    ranked = customer_value(tables).withColumn("total", F.round("spent", 2)) \
        .orderBy(F.desc("total"), "customer_id").limit(limit)
    people = tables.customers("customer_id", "first_name", "last_name", "segment", "city")
    return ranked.join(people, "customer_id").select(
        "customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("name"),
        "segment", "city", F.col("orders").alias("total_orders"),
        money("spent").alias("lifetime_value"), ratio("spent", "orders", 2).alias("avg_order_value"),
        "last_order_date").orderBy(F.desc("lifetime_value"), "customer_id")


def _with_returns(lines: DataFrame, tables: Tables) -> DataFrame:
    """Distinct rows of ``lines`` in delivered and returned orders, with the order's returns.

    Dealt by order once, a bounded number of lines to a task: that serves the distinct rows as well as
    the join with the orders.
    """
    per_order = tables.returns("order_id", "return_id").groupBy("order_id") \
        .agg(F.count("return_id").alias("returns"))
    orders = orders_in(tables, FULFILLED, "order_id").join(per_order, "order_id", "left") \
        .na.fill(0, ["returns"])
    width = grouped_width(lines.sparkSession, tables.row_count("order_items"))
    return lines.repartition(width, "order_id").distinct() \
        .join(orders.repartition(width, "order_id"), "order_id")


def product_return_rate(tables: Tables, min_orders: int = 5, limit: int = 10) -> DataFrame:
    """An order's return counts for every product in it."""
    lines = tables.order_items("order_id", "product_id")
    rated = _with_returns(lines, tables).groupBy("product_id").agg(
        F.count("order_id").alias("total_orders"), F.sum("returns").alias("returns"))
    rate = percent("returns", "total_orders", 1)
    top = rated.where(F.col("total_orders") >= min_orders).withColumn("return_rate_pct", rate) \
        .orderBy(F.desc("return_rate_pct"), "product_id").limit(limit)
    return top.join(tables.products("product_id", "product_name", "category"), "product_id") \
        .select("product_id", "product_name", "category", "total_orders", "returns",
                "return_rate_pct").orderBy(F.desc("return_rate_pct"), "product_id")


def category_return_rate(tables: Tables) -> DataFrame:
    """The same rate per category: an order counts once for each category in it."""
    categories = tables.products("product_id", "category")
    lines = tables.order_items("order_id", "product_id").join(categories, "product_id")
    rated = _with_returns(lines.select("order_id", "category"), tables).groupBy("category").agg(
        F.count("order_id").alias("total_orders"), F.sum("returns").alias("returns"))
    return rated.withColumn("return_rate_pct", percent("returns", "total_orders", 1))


def customers_by_state(tables: Tables) -> DataFrame:
    return tables.customers("state").groupBy("state") \
        .agg(F.count(F.lit(1)).alias("customers"))


def product_kpis(tables: Tables) -> DataFrame:
    """Product count, return rate and the category with the best margin."""
    products = tables.products("product_id").agg(F.count(F.lit(1))).scalar()
    rate = return_rate(tables).select("return_rate_pct").scalar()
    best = category_margin(tables).orderBy(F.desc("margin_pct"), "category").limit(1)
    return best.select(products.alias("total_products"), rate.alias("return_rate_pct"),
                       F.col("category").alias("best_margin_category"), "margin_pct")


def product_margin_table(tables: Tables, category: str | None = None) -> DataFrame:
    """Revenue, margin and units per product; with a category, the drill-through of its chart."""
    products = tables.products("product_id", "product_name", "category", "cost_price")
    if category is not None:
        products = products.where(F.col("category") == category)
    profit = F.col("revenue") - F.col("units") * F.col("cost_price")
    return product_sales(tables).join(products, "product_id").select(
        "product_id", "product_name", "category", F.col("units").alias("units_sold"),
        money("revenue").alias("revenue"), money(profit).alias("profit"),
        ratio(profit, "revenue", 6).alias("margin"))


def return_reasons(tables: Tables) -> DataFrame:
    return tables.returns("reason").groupBy("reason").agg(F.count(F.lit(1)).alias("returns"))


def category_margin_rank(tables: Tables) -> DataFrame:
    """Categories by revenue and by margin, so a big seller with a poor margin shows."""
    profit = F.col("revenue") - F.col("cost")
    sold = category_sales(tables).select("category", money("revenue").alias("revenue"),
                                         ratio(profit, "revenue", 6).alias("margin"))

    def place(column: str) -> Column:
        return F.rank().over(Window.orderBy(F.desc_nulls_last(column))).cast("bigint")

    return sold.withColumns({"revenue_rank": place("revenue"), "margin_rank": place("margin")})


def channel_mix(tables: Tables) -> DataFrame:
    return channel_summary(tables).withColumn(
        "order_share", ratio("orders", F.sum("orders").over(whole()), 6))


def state_concentration(tables: Tables) -> DataFrame:
    """Revenue share of the n strongest states together, for every n."""
    states = state_analysis(tables).select("state", "revenue")
    so_far = Window.orderBy(F.desc("revenue"), "state").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    exact = F.col("revenue").cast("decimal(28,2)")
    return states.select(
        "state", "revenue", F.row_number().over(so_far).cast("bigint").alias("states"),
        ratio(F.sum(exact).over(so_far), F.sum(exact).over(whole()), 6).alias("cumulative_share"))
