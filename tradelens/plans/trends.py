"""Month, quarter and year trends.

Orders are grouped by the first day of their period; labels are put on the few grouped rows.
"Previous month" means the previous month that has orders, except in ``mom_growth_calendar``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelens.functions.labels import weekday_name, year_month
from tradelens.functions.numeric import half_up, money, percent, ratio, real, total
from tradelens.plans.common import LINE_MEASURES, delivered, order_count, order_value, whole
from tradelens.sources.tables import Tables


def order_calendar(tables: Tables) -> DataFrame:
    """Orders with the calendar columns of their date."""
    day = F.col("order_date")
    quarter = F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))
    return tables.orders().withColumns({
        "total_amount": money("total_amount"),
        "year": F.year(day), "month": F.month(day), "year_month": year_month(day),
        "quarter": quarter, "dow": weekday_name(day)})


def order_detail(tables: Tables) -> DataFrame:
    """Lines with their order, product and profit; all statuses."""
    orders = tables.orders("order_id", "customer_id", "order_date", "status", "discount_pct")
    items = tables.order_items("item_id", "order_id", "product_id", "discount_pct",
                               *LINE_MEASURES)
    products = tables.products("product_id", "product_name", "category", "brand", "cost_price")
    profit = F.col("line_revenue") - F.col("quantity") * F.col("cost_price")
    day = F.col("order_date")
    return (items.join(orders.withColumnRenamed("discount_pct", "order_discount_pct"), "order_id")
            .join(products, "product_id")
            .select("item_id", "order_id", "product_id", "customer_id", "order_date", "status",
                    F.year(day).alias("year"), F.month(day).alias("month"),
                    year_month(day).alias("year_month"), "discount_pct", "order_discount_pct",
                    "quantity", half_up(F.col("unit_price"), 4).alias("unit_price"),
                    money("line_revenue", 4).alias("line_revenue"), "product_name", "category",
                    "brand", real("cost_price").alias("cost_price"),
                    money(profit, 4).alias("profit")))


def _periods(tables: Tables, period: str, *columns: str) -> DataFrame:
    orders = delivered(tables, "order_date", "total_amount", *columns)
    return orders.withColumn("start", F.trunc("order_date", period))


def monthly_revenue(tables: Tables) -> DataFrame:
    months = order_value(_periods(tables, "month"), "start")
    return months.select(
        F.date_format("start", "yyyy").alias("year"), F.date_format("start", "MM").alias("month"),
        year_month("start").alias("year_month"), "orders", "revenue", "aov").orderBy("year_month")


def _months(tables: Tables) -> DataFrame:
    """Exact revenue per month, next to that of the previous month with orders."""
    months = _periods(tables, "month").groupBy("start").agg(F.sum("total_amount").alias("revenue"))
    in_order = Window.orderBy("start")
    return months.withColumns({"before": F.lag("revenue").over(in_order),
                               "start_before": F.lag("start").over(in_order)})


def _growth(now: Column | str = "revenue", before: Column | str = "before") -> Column:
    now, before = (F.col(c) if isinstance(c, str) else c for c in (now, before))
    return ratio(now - before, before)


def mom_growth(tables: Tables) -> DataFrame:
    return _months(tables).select(
        year_month("start").alias("ym"), money("revenue").alias("revenue"),
        money("before").alias("prev_revenue"),
        percent(F.col("revenue") - F.col("before"), "before", 1).alias("mom_growth_pct"),
    ).orderBy("ym")


def monthly_trend(tables: Tables) -> DataFrame:
    return _months(tables).select(
        year_month("start").alias("year_month"), money("revenue").alias("revenue"),
        half_up(_growth() * 100, 6).alias("mom_growth"))


def monthly_with_index(tables: Tables) -> DataFrame:
    """Growth as a fraction, zero for the first month, and revenue against the best month."""
    return _months(tables).select(
        year_month("start").alias("year_month"), money("revenue").alias("revenue"),
        half_up(F.coalesce(_growth(), F.lit(0.0)), 6).alias("mom_growth"),
        ratio("revenue", F.max("revenue").over(whole()), 6).alias("volume_index"),
    ).orderBy("year_month")


def mom_growth_calendar(tables: Tables) -> DataFrame:
    """Growth over the calendar month before; zero where that month has no revenue."""
    month_before = F.add_months("start", -1)
    before = F.when(F.col("start_before") == month_before, F.col("before"))
    return _months(tables).select(
        year_month("start").alias("year_month"), money("revenue").alias("revenue"),
        half_up(F.coalesce(_growth("revenue", before), F.lit(0.0)), 6).alias("mom_growth"))


def yoy_growth(tables: Tables) -> DataFrame:
    """Growth is taken from the rounded yearly revenue."""
    per_customer = _periods(tables, "year", "customer_id").groupBy("start", "customer_id").agg(
        order_count().alias("n"), F.sum("total_amount").alias("spent"))
    years = per_customer.groupBy("start").agg(
        F.sum("n").alias("orders"), F.round(F.sum("spent"), 2).alias("revenue"),
        ratio(F.sum("spent"), F.sum("n"), 2).alias("aov"),
        F.count("customer_id").alias("unique_customers"))
    before = F.lag("revenue").over(Window.orderBy("start"))
    return years.select(
        F.date_format("start", "yyyy").alias("yr"), "orders", real("revenue").alias("revenue"),
        "aov", "unique_customers",
        percent(F.col("revenue") - before, before, 1).alias("yoy_growth_pct"))


def quarterly_performance(tables: Tables) -> DataFrame:
    quarters = order_value(_periods(tables, "quarter"), "start")
    return quarters.select(
        F.date_format("start", "yyyy").alias("year"),
        F.concat(F.lit("Q"), F.quarter("start").cast("string")).alias("quarter"),
        "orders", "revenue").orderBy("year", "quarter")


def category_by_year(tables: Tables, years: list[str] | None = None) -> DataFrame:
    """Category x year revenue; without a list, every year with delivered orders gets a column.

    The years come from the orders alone, so finding them does not run the join of the lines.
    """
    kept = delivered(tables, "order_id", "order_date").select(
        "order_id", F.year("order_date").cast("string").alias("year"))
    if years is None:
        years = sorted(row["year"] for row in kept.select("year").distinct().collect())
    lines = tables.order_items("order_id", "product_id", "line_revenue").join(kept, "order_id")
    per_product = lines.groupBy("product_id", "year").agg(F.sum("line_revenue").alias("revenue"))
    return per_product.join(tables.products("product_id", "category"), "product_id") \
        .groupBy("category").pivot("year", years).agg(total("revenue"))


def year_quarter_matrix(tables: Tables) -> DataFrame:
    quarters = _periods(tables, "quarter").groupBy("start").agg(
        F.sum("total_amount").alias("revenue"))
    return quarters.groupBy(F.year("start").alias("year")).agg(
        *[money(F.sum(F.when(F.quarter("start") == q, F.col("revenue")))).alias(f"Q{q}")
          for q in (1, 2, 3, 4)])


def q4_vs_q1(tables: Tables) -> DataFrame:
    return year_quarter_matrix(tables).select(
        "year", F.col("Q1").alias("q1_revenue"), F.col("Q4").alias("q4_revenue"),
        half_up(_growth("Q4", "Q1") * 100, 4).alias("q4_over_q1_pct"))


def orders_by_weekday(tables: Tables) -> DataFrame:
    """Grouped by day first, so names are put on days and not on orders."""
    days = delivered(tables, "order_date", "total_amount").groupBy("order_date").agg(
        order_count().alias("n"), F.sum("total_amount").alias("revenue"))
    return days.groupBy(weekday_name("order_date").alias("day_of_week")).agg(
        F.sum("n").alias("orders"), total("revenue").alias("revenue"),
    ).orderBy(F.desc("orders"), "day_of_week")
