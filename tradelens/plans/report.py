"""Report sections, the data dictionary, and writing them out."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.functions.display import currency, percent_text, thousands
from tradelens.plans import (
    basket, cohorts, model, overview, quality, rfm, stats, topn, trends,
)
from tradelens.functions.numeric import money, total
from tradelens.session import materialise, shared_path
from tradelens.sources import schema, stored
from tradelens.sources.tables import Tables


def data_dictionary(tables: Tables) -> DataFrame:
    """Every column with type, description and its smallest value as an example."""
    def one(table: str) -> DataFrame:
        fields = {f.name: f for f in schema.SCHEMAS[table]}
        names = tables.columns(table)
        long = tables.smallest(table).unpivot([], names, "column", "example")

        def lookup(pick):
            pairs = [F.lit(x) for name in names for x in (name, pick(fields[name]))]
            return F.element_at(F.create_map(*pairs), F.col("column"))

        return long.select(
            F.lit(table).alias("table"), "column",
            lookup(lambda f: f.dataType.simpleString()).alias("type"),
            lookup(lambda f: f.metadata["comment"]).alias("description"), "example")

    return reduce(DataFrame.unionByName, [one(name) for name in schema.TABLE_NAMES])


def kpi_tiles(tables: Tables) -> DataFrame:
    """The summary page's tiles as (tile, value), the values as they are printed."""
    tiles = {
        "Total Revenue": currency("total_revenue"),
        "Total Orders": thousands("total_orders"),
        "Avg Order Value": currency("avg_order_value"),
        "Unique Customers": thousands("unique_customers"),
        "Return Rate": percent_text("return_pct"),
        "Cancel Rate": percent_text("cancellation_pct"),
        "Avg Discount": percent_text("avg_discount_pct"),
        "Gross Margin": percent_text("gross_margin_pct"),
    }
    wide = overview.dashboard_kpis(tables).select(
        *[text.alias(name) for name, text in tiles.items()])
    return wide.unpivot([], list(tiles), "tile", "value")


class SettledOrders(Tables):
    """Tables whose orders were written once, for reports that read them many times."""

    def __init__(self, base: Tables):
        orders = materialise(base.raw_orders())
        super().__init__({"orders": orders})
        self._base = base
        self.generated = base.generated

    def columns(self, name: str) -> list[str]:
        return self._base.columns(name)

    def row_count(self, name: str) -> int:
        return self._base.row_count(name)

    def customers(self, *columns: str) -> DataFrame:
        return self._base.customers(*columns)

    def products(self, *columns: str) -> DataFrame:
        return self._base.products(*columns)

    def order_items(self, *columns: str) -> DataFrame:
        return self._base.order_items(*columns)

    def smallest(self, name: str) -> DataFrame:
        return self._base.smallest(name)

    def returns(self, *columns: str) -> DataFrame:
        return self._base.returns(*columns)


def sql_sections(tables: Tables, reference: date) -> dict[str, DataFrame]:
    """The analytical statements, by name."""
    return {
        **{f.__name__: f(tables) for f in (
            quality.null_audit, quality.fill_null_totals, quality.order_outliers, quality.duplicate_orders,
            quality.orphan_items, overview.orders_by_status, overview.revenue_by_category,
            overview.customers_by_segment_state, overview.payment_mode_summary,
            overview.channel_summary, topn.top_products_revenue, overview.kpi_overview,
            overview.gross_margin, overview.return_rate, overview.clv_by_segment,
            overview.discount_bands, trends.monthly_revenue, trends.mom_growth,
            trends.yoy_growth, trends.quarterly_performance, cohorts.cohort_retention,
            topn.top_states, topn.top_customers, topn.product_return_rate,
            trends.orders_by_weekday, cohorts.new_vs_repeat, basket.category_basket_pairs)},
        "rfm_customers": rfm.rfm_customers(tables, reference),
        "rfm_segments": rfm.rfm_segments_ntile(tables, reference),
    }


def eda_sections(tables: Tables, reference: date) -> dict[str, DataFrame]:
    """What lies behind the exploratory charts and tests, by name."""
    return {
        **{f.__name__: f(tables) for f in (
            quality.table_profile, trends.order_calendar, trends.order_detail, overview.headline_stats, overview.status_counts,
            overview.revenue_by_segment, stats.order_value_describe, trends.monthly_trend,
            overview.category_margin, stats.order_value_histogram, stats.order_value_density,
            stats.order_value_box_by_segment, overview.payment_channel_matrix,
            overview.revenue_by_payment, stats.customer_features, stats.customer_correlations,
            stats.orders_revenue_trend, stats.orders_revenue_trend_line, stats.normality_check,
            stats.segment_ttest, stats.pearson_test, stats.discount_ttest,
            model.clv_regression)},
        "rfm_quantile": rfm.rfm_quantile(tables, reference),
        "rfm_segment_summary": rfm.rfm_segment_summary(tables, reference),
    }


def dashboard(tables: Tables, reference: date = rfm.REFERENCE_DATE) -> dict[str, DataFrame]:
    """The workbook's sheets by name, each one a result of its own.

    Most sections of a report start from the orders; where those are derived, pass
    ``SettledOrders(tables)``.
    """
    return {
        "summary_tiles": kpi_tiles(tables),
        "summary_kpis": overview.dashboard_kpis(tables),
        "summary_months": trends.monthly_with_index(tables),
        "category_performance": overview.category_performance(tables),
        "customer_rfm": rfm.rfm_report(tables, reference),
        "state_analysis": overview.state_analysis(tables),
        "data_dictionary": data_dictionary(tables),
    }


def write_report(sections: dict[str, DataFrame], folder: str, kind: str = "parquet") -> None:
    """One dataset per section, each one checked and then put in the place of an earlier one."""
    for name, df in sections.items():
        stored.replace(df, f"{folder}/{name}", kind)


def export_tables(tables: Tables, folder: str, kind: str = "parquet") -> None:
    """All five tables in canonical columns and types, one dataset each, replaced when present.

    Columns a source does not have are written empty, so ``Tables.from_parquet`` and
    ``from_csv`` read the result back.
    """
    for name in schema.TABLE_NAMES:
        stored.replace(stored.canonical(tables, name), f"{folder}/{name}", kind)


def exported_tables(tables: Tables, kind: str = "parquet") -> DataFrame:
    """The tables written to the shared folder and read again: rows, keys and a sum of each."""
    spark = tables.customers("customer_id").sparkSession
    folder = shared_path(spark)
    export_tables(tables, folder, kind)
    back = Tables.from_csv(spark, folder) if kind == "csv" else Tables.from_parquet(spark, folder)

    def one(name: str, amount: str) -> DataFrame:
        rows = back.raw_orders() if name == "orders" else back.table(name)
        key = schema.PRIMARY_KEYS[name]
        return rows.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"),
                        F.count_distinct(key).alias("keys"), total(amount).alias("amount"))

    amounts = {"customers": "customer_id", "products": "cost_price", "orders": "total_amount",
               "order_items": "line_revenue", "returns": "order_id"}
    return reduce(DataFrame.unionByName, [one(*pair) for pair in amounts.items()])


def stored_totals(tables: Tables) -> DataFrame:
    """Orders stored by month with missing totals, updated in place, and read again."""
    spark = tables.customers("customer_id").sparkSession
    path = shared_path(spark)
    stored.store_orders(tables, path)
    stored.fill_stored_totals(spark, path)
    return stored.stored_orders(spark, path).select("order_id", money("total_amount").alias("total_amount"))


def save_tables(tables: Tables, database: str) -> None:
    """The same as catalog tables, facts bucketed on the order key so that joins need no shuffle.

    Rows are dealt by the bucket's key first: one file a bucket.
    """
    buckets = int(tables.customers().sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = {"orders": "order_id", "order_items": "order_id", "returns": "order_id"}
    for name in schema.TABLE_NAMES:
        rows = tables.table(name)
        if name in keys:
            rows = rows.repartition(buckets, keys[name])
        writer = rows.write.mode("overwrite").format("parquet")
        if name in keys:
            writer = writer.bucketBy(buckets, keys[name]).sortBy(keys[name])
        writer.saveAsTable(f"{database}.{name}")
