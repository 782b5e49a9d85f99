"""Report measures under slicers.

``sliced`` narrows a set of tables; every analysis of this package then runs on the narrowed
tables unchanged. The five measures take ``by``, the columns of the visual they sit in.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelens.functions.labels import year_month
from tradelens.functions.numeric import money, percent, ratio, total
from tradelens.plans.common import CANCELLED, DELIVERED, RETURNED, delivered, order_count
from tradelens.plans.overview import category_performance
from tradelens.session import grouped_width
from tradelens.sources.tables import Tables


@dataclass(frozen=True)
class Slicers:
    """Selections of the report page; None leaves a slicer open."""

    date_from: date | None = None
    date_to: date | None = None
    years: tuple[int, ...] | None = None
    segments: tuple[str, ...] | None = None
    categories: tuple[str, ...] | None = None
    states: tuple[str, ...] | None = None
    statuses: tuple[str, ...] | None = None
    channels: tuple[str, ...] | None = None


class SlicedTables(Tables):
    """Tables seen through slicers.

    Slicers on order columns filter orders; the customer and product slicers reach orders through
    semi-joins (an order stays when one of its lines is in the chosen categories). Lines and
    returns follow their orders, so visuals filter each other.
    """

    def __init__(self, base: Tables, slicers: Slicers):
        self._base, self._s = base, slicers
        self.generated = base.generated

    def columns(self, name: str) -> list[str]:
        return self._base.columns(name)

    def row_count(self, name: str) -> int:
        return self._base.row_count(name)  # an upper bound

    def input_bytes(self) -> int:
        return self._base.input_bytes()

    def customers(self, *columns: str) -> DataFrame:
        names = columns or tuple(self.columns("customers"))
        return self._narrow(self._base.customers, names, self._in("segment", self._s.segments))

    def products(self, *columns: str) -> DataFrame:
        names = columns or tuple(self.columns("products"))
        return self._narrow(self._base.products, names, self._in("category", self._s.categories))

    def _in(self, column: str, chosen) -> dict[str, Column]:
        return {} if chosen is None else {column: F.col(column).isin(list(chosen))}

    def _both(self, statuses: list[str] | None) -> list[str] | None:
        """Statuses that the caller wants and the slicer allows."""
        chosen = self._s.statuses
        if statuses is None or chosen is None:
            return statuses if chosen is None else list(chosen)
        return [s for s in statuses if s in chosen]

    @staticmethod
    def _narrow(read, names: tuple[str, ...], tests: dict[str, Column]) -> DataFrame:
        df = read(*dict.fromkeys([*names, *tests]))
        for test in tests.values():
            df = df.where(test)
        return df.select(*names)

    def _order_tests(self) -> dict[str, Column]:
        s, day = self._s, F.col("order_date")
        tests = {**self._in("state", s.states), **self._in("channel", s.channels)}
        when = [day >= F.lit(s.date_from)] if s.date_from else []
        when += [day <= F.lit(s.date_to)] if s.date_to else []
        when += [F.year(day).isin(list(s.years))] if s.years is not None else []
        if when:
            test = when[0]
            for more in when[1:]:
                test = test & more
            tests["order_date"] = test
        return tests

    def raw_orders(self, *columns: str, statuses: list[str] | None = None) -> DataFrame:
        names = columns or tuple(self.columns("orders"))
        links = (["customer_id"] if self._s.segments is not None else []) \
            + (["order_id"] if self._s.categories is not None else [])
        read = partial(self._base.raw_orders, statuses=self._both(statuses))
        df = self._narrow(read, tuple(dict.fromkeys([*names, *links])), self._order_tests())
        if self._s.segments is not None:
            df = df.join(self.customers("customer_id"), "customer_id", "left_semi")
        if self._s.categories is not None:
            df = df.join(self._chosen_lines("order_id").distinct(), "order_id", "left_semi")
        return df.select(*names)

    def _chosen_lines(self, *columns: str) -> DataFrame:
        names = columns or tuple(self.columns("order_items"))
        lines = self._base.order_items(*dict.fromkeys([*names, "product_id"]))
        if self._s.categories is not None:
            lines = lines.join(self.products("product_id"), "product_id", "left_semi")
        return lines.select(*names)

    def _of_kept_orders(self, df: DataFrame, names: tuple[str, ...]) -> DataFrame:
        s = self._s
        if self._order_tests() or any(x is not None for x in (s.statuses, s.segments, s.categories)):
            df = df.join(self.raw_orders("order_id"), "order_id", "left_semi")
        return df.select(*names)

    def order_items(self, *columns: str) -> DataFrame:
        names = columns or tuple(self.columns("order_items"))
        return self._of_kept_orders(self._chosen_lines(*dict.fromkeys([*names, "order_id"])), names)

    def returns(self, *columns: str) -> DataFrame:
        names = columns or tuple(self.columns("returns"))
        return self._of_kept_orders(
            self._base.returns(*dict.fromkeys([*names, "order_id"])), names)


def sliced(tables: Tables, slicers: Slicers) -> Tables:
    return SlicedTables(tables, slicers)


# -- the five measures -------------------------------------------------------------------------

def _in_context(tables: Tables, by: list[str], *columns: str,
                statuses: list[str] | None = None) -> DataFrame:
    """Orders with the columns of the visual; the customer's segment is looked up when asked."""
    own = [c for c in by if c != "segment"]
    link = ["customer_id"] if "segment" in by else []
    orders = tables.orders(*dict.fromkeys([*own, *columns, *link, "status"]), statuses=statuses)
    if "segment" in by:
        orders = orders.join(tables.customers("customer_id", "segment"), "customer_id")
    return orders


def _delivered_amount() -> Column:
    return F.sum(F.when(F.col("status") == DELIVERED, F.col("total_amount")))


def total_revenue(tables: Tables, by: list[str] = ()) -> DataFrame:
    return _in_context(tables, by, "total_amount", statuses=[DELIVERED]) \
        .groupBy(*by).agg(total("total_amount").alias("total_revenue"))


def aov(tables: Tables, by: list[str] = ()) -> DataFrame:
    done = F.count_if(F.col("status") == DELIVERED)
    value = F.coalesce(ratio(_delivered_amount(), done, 2), F.lit(0.0))
    return _in_context(tables, by, "total_amount").groupBy(*by).agg(value.alias("aov"))


def clv(tables: Tables, by: list[str] = ()) -> DataFrame:
    """Delivered revenue per customer with an order of any status."""
    per_customer = _in_context(tables, by, "customer_id", "total_amount") \
        .groupBy(*by, "customer_id").agg(_delivered_amount().alias("spent"))
    value = ratio(F.sum("spent"), F.count("customer_id"), 2)
    return per_customer.groupBy(*by).agg(F.coalesce(value, F.lit(0.0)).alias("clv"))


def return_rate_status(tables: Tables, by: list[str] = ()) -> DataFrame:
    """Share of returned among delivered and returned orders, by status alone."""
    returned = F.count_if(F.col("status") == RETURNED)
    either = F.count_if(F.col("status").isin(DELIVERED, RETURNED))
    value = F.coalesce(ratio(returned, either, 6), F.lit(0.0))
    return _in_context(tables, by, "status").groupBy(*by).agg(value.alias("return_rate"))


def page_cards(tables: Tables) -> DataFrame:
    """Revenue, orders, average value, active customers and status rates under the slicers."""
    orders = tables.orders("customer_id", "status", "total_amount")
    per_customer = orders.groupBy("customer_id").agg(
        order_count().alias("n"), _delivered_amount().alias("spent"),
        F.count_if(F.col("status") == DELIVERED).alias("done"),
        F.count_if(F.col("status") == CANCELLED).alias("cancelled"))
    return per_customer.agg(
        total("spent").alias("total_revenue"),
        F.coalesce(F.sum("done"), F.lit(0)).alias("orders"),
        F.coalesce(ratio(F.sum("spent"), F.sum("done"), 2), F.lit(0.0)).alias("aov"),
        F.count(F.when(F.col("done") > 0, F.col("customer_id"))).alias("active_customers"),
        percent(F.sum("cancelled"), F.sum("n"), 4).alias("cancel_pct"))


SLICED_BY = ["year", "segment", "state", "status", "channel"]


def slicer_cube(tables: Tables) -> DataFrame:
    """Revenue, orders and customers for every combination of the slicers, each set or left open.

    ``open`` is the grouping id: a bit for each of ``SLICED_BY``, the first one highest, set where the
    slicer is open and its column NULL. Slice the tables by dates or categories first for those.

    Orders are summed per customer and combination before they are grouped by all the sets, so that
    customers are counted without a distinct and a customer with very many orders is a few rows. These
    rows are dealt by customer, a bounded number to a task, and each task takes them through all the
    sets by itself: only the sums of its combinations leave it.
    """
    people = tables.customers("customer_id", "segment")
    orders = tables.orders("customer_id", "order_date", "status", "channel", "state", "total_amount") \
        .join(people, "customer_id").withColumn("year", F.year("order_date"))
    each = orders.groupBy(*SLICED_BY, "customer_id").agg(
        order_count().alias("orders"), _delivered_amount().alias("revenue"),
        F.count_if(F.col("status") == DELIVERED).alias("delivered"))
    sets = 1 << len(SLICED_BY)
    width = grouped_width(each.sparkSession, tables.row_count("orders"), sets)
    opened = each.repartition(width, "customer_id") \
        .withColumn("open", F.explode(F.array(*[F.lit(mask).cast("bigint") for mask in range(sets)])))
    for i, c in enumerate(reversed(SLICED_BY)):
        opened = opened.withColumn(c, F.when(F.col("open").bitwiseAND(1 << i) == 0, F.col(c)))
    per_customer = opened.groupBy("customer_id", "open", *SLICED_BY).agg(
        F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"),
        F.sum("delivered").alias("delivered"))
    return per_customer.groupBy("open", *SLICED_BY).agg(
        F.sum("orders").alias("orders"), total("revenue").alias("revenue"),
        order_count().alias("customers"), F.count_if(F.col("delivered") > 0).alias("active_customers"))


def revenue_by_month(tables: Tables) -> DataFrame:
    months = delivered(tables, "order_date", "total_amount") \
        .groupBy(F.trunc("order_date", "month").alias("m")) \
        .agg(F.sum("total_amount").alias("revenue"))
    return months.select(year_month("m").alias("year_month"), money("revenue").alias("revenue"))


def category_revenue_share(tables: Tables) -> DataFrame:
    """Slices of the category ring."""
    return category_performance(tables).select("category", "revenue", "revenue_share")
