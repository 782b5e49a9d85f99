"""Small tables with known answers."""

from __future__ import annotations

import math
from datetime import date
from decimal import Decimal

import pytest

from tests.micro import make, orders
from tradelens.functions.student_t import t_two_sided
from tradelens.plans import (
    basket, cohorts, measures, model, overview, quality, report, rfm, stats, topn, trends,
)
from tradelens.plans.measures import Slicers, sliced

CUSTOMERS = [{"customer_id": i, "email": f"c{i}@x"} for i in range(1, 8)]
PRODUCTS = [{"product_id": 1, "category": "Home"}, {"product_id": 2, "category": "Books"}]


def rows(df):
    return [tuple(r) for r in df.collect()]


def one(df):
    got = df.collect()
    assert len(got) == 1
    return got[0]


# -- preparation and quality -------------------------------------------------------------------

def test_null_total_counts_as_zero_everywhere_but_the_audit(spark):
    t = make(spark, customers=CUSTOMERS, orders=orders(10, None, 30))
    audit = {r["tbl"]: r for r in quality.null_audit(t).collect()}
    assert audit["orders"]["null_email"] == 1
    assert one(measures.aov(t))["aov"] == pytest.approx(13.33)
    assert sorted(r["total_amount"] for r in quality.fill_null_totals(t).collect()) == [0, 10, 30]


def test_constant_amounts_have_no_outliers(spark):
    t = make(spark, orders=orders(*[5] * 20))
    assert rows(quality.order_outliers(t)) == []
    assert one(stats.normality_check(t))["p_value"] is None


def test_outlier_is_found(spark):
    t = make(spark, orders=orders(*[10, 11] * 15, 900))
    assert [r["order_id"] for r in quality.order_outliers(t).collect()] == [31]


def test_duplicates_orphans_and_constraints(spark):
    t = make(spark, customers=[{"customer_id": 1, "email": "a"}, {"customer_id": 2, "email": "a"}],
             products=PRODUCTS,
             orders=[{"order_id": 1}, {"order_id": 1}, {"order_id": 2, "status": "Lost"}],
             order_items=[{"item_id": 1, "order_id": 1}, {"item_id": 2, "order_id": 9}],
             returns=[{"return_id": 1, "order_id": 2, "return_date": date(2024, 3, 1)}])
    assert rows(quality.duplicate_orders(t)) == [(1, 2)]
    assert rows(quality.orphan_items(t)) == [(2, 9)]
    assert rows(quality.orders_without_items(t)) == [(2,)]
    broken = {(r["rule"], r["column"]): r["violations"]
              for r in quality.constraint_report(t).collect() if r["violations"]}
    assert broken == {("primary_key", "order_id"): 1, ("unique", "email"): 1,
                      ("allowed_values", "status"): 1, ("foreign_key", "order_id"): 1,
                      ("sum_of_lines", "total_amount"): 1, ("days_after_order", "return_date"): 1,
                      ("of_returned_order", "order_id"): 1}


def test_line_revenue_rounds_half_a_cent_up(spark):
    t = make(spark, order_items=[{"item_id": 1, "order_id": 1, "quantity": 1,
                                  "unit_price": 10.05, "discount_pct": 0.1}])
    assert one(quality.line_revenue(t))["computed_revenue"] == 9.05  # 9.045


def test_sample_is_exact_and_repeatable(spark):
    t = make(spark, orders=orders(*range(1, 301)))
    first = sorted(rows(quality.sample_orders(t, rows=50)))
    assert len(first) == 50 == len(set(first))
    assert first == sorted(rows(quality.sample_orders(t, rows=50)))
    assert first != sorted(rows(quality.sample_orders(t, rows=50, seed=7)))
    assert quality.sample_orders(t, rows=1000).count() == 300


# -- overview ----------------------------------------------------------------------------------

def test_fan_out_of_order_totals(spark):
    t = make(spark, customers=CUSTOMERS, products=PRODUCTS,
             orders=[{"order_id": 1, "total_amount": Decimal("30")},
                     {"order_id": 2, "customer_id": 2, "total_amount": Decimal("10")}],
             order_items=[{"item_id": i, "order_id": 1} for i in (1, 2, 3)]
             + [{"item_id": 4, "order_id": 2}])
    true, written = one(overview.kpi_overview(t)), one(overview.kpi_overview_as_written(t))
    assert (true["gross_revenue"], true["avg_order_value"]) == (40.0, 20.0)
    assert (written["gross_revenue"], written["avg_order_value"]) == (100.0, 25.0)
    assert true["total_units_sold"] == written["total_units_sold"] == 4.0


def test_discount_band_edges(spark):
    discounts = [None, 0.0, 0.1, 0.1000001, 0.2, 0.25]
    t = make(spark, orders=[{"order_id": i, "discount_pct": d}
                            for i, d in enumerate(discounts, 1)])
    got = {r["discount_band"]: r["orders"] for r in overview.discount_bands(t).collect()}
    assert got == {"No Discount": 1, "Up to 10%": 1, "11-20%": 2, "Above 20%": 2}


def test_two_returns_of_one_order(spark):
    t = make(spark, products=PRODUCTS, orders=[{"order_id": 1, "status": "Returned"},
                                               {"order_id": 2}],
             order_items=[{"item_id": 1, "order_id": 1}, {"item_id": 2, "order_id": 1},
                          {"item_id": 3, "order_id": 2}],
             returns=[{"return_id": 1, "order_id": 1}, {"return_id": 2, "order_id": 1}])
    assert tuple(one(overview.return_rate(t))) == (2, 2, 100.0)
    got = one(topn.product_return_rate(t, min_orders=1))
    assert (got["total_orders"], got["returns"]) == (2, 2)
    assert one(topn.category_return_rate(t))["returns"] == 2


def test_status_rates_use_all_orders(spark):
    t = make(spark, customers=CUSTOMERS, orders=[
        {"order_id": i, "status": s} for i, s in
        enumerate(["Delivered", "Cancelled", "Returned", "Shipped"], 1)])
    head = one(overview.headline_stats(t))
    assert (head["cancellation_pct"], head["return_pct"], head["total_orders"]) == (25.0, 25.0, 1)
    assert one(measures.return_rate_status(t))["return_rate"] == 0.5


def test_margin_flag_and_unweighted_mean(spark):
    t = make(spark, products=[{"product_id": 1, "category": "A", "cost_price": Decimal("9")},
                              {"product_id": 2, "category": "B", "cost_price": Decimal("1")}],
             orders=[{"order_id": 1}],
             order_items=[{"item_id": 1, "order_id": 1, "product_id": 1},
                          {"item_id": 2, "order_id": 1, "product_id": 2,
                           "line_revenue": Decimal("10")}])
    got = {r["category"]: r for r in overview.category_margin(t).collect()}
    assert got["A"]["below_target"] and not got["B"]["below_target"]
    assert got["A"]["avg_margin_pct"] == 50.0


# -- trends ------------------------------------------------------------------------------------

def month_gap(spark):
    days = [(date(2024, 1, 5), 100), (date(2024, 2, 1), 0), (date(2024, 4, 9), 50)]
    return make(spark, orders=[{"order_id": i, "order_date": d, "total_amount": Decimal(a)}
                               for i, (d, a) in enumerate(days, 1)])


def test_growth_over_previous_row_and_previous_month(spark):
    t = month_gap(spark)
    by_row = {r["ym"]: r["mom_growth_pct"] for r in trends.mom_growth(t).collect()}
    assert by_row == {"2024-01": None, "2024-02": -100.0, "2024-04": None}
    calendar = {r["year_month"]: r["mom_growth"]
                for r in trends.mom_growth_calendar(t).collect()}
    assert calendar == {"2024-01": 0.0, "2024-02": -1.0, "2024-04": 0.0}
    index = {r["year_month"]: r["volume_index"] for r in trends.monthly_with_index(t).collect()}
    assert index == {"2024-01": 1.0, "2024-02": 0.0, "2024-04": 0.5}


def test_calendar_labels(spark):
    t = make(spark, orders=[{"order_id": 1, "order_date": date(2024, 6, 9)}])
    got = one(trends.order_calendar(t))
    assert (got["year_month"], got["quarter"], got["dow"]) == ("2024-06", "2024Q2", "Sunday")


def test_yearly_growth_and_quarters(spark):
    t = make(spark, orders=[
        {"order_id": 1, "order_date": date(2022, 2, 1), "total_amount": Decimal("100")},
        {"order_id": 2, "order_date": date(2023, 11, 1), "total_amount": Decimal("150")},
        {"order_id": 3, "order_date": date(2023, 1, 1), "total_amount": Decimal("50")}])
    growth = {r["yr"]: r["yoy_growth_pct"] for r in trends.yoy_growth(t).collect()}
    assert growth == {"2022": None, "2023": 100.0}
    gap = {r["year"]: r["q4_over_q1_pct"] for r in trends.q4_vs_q1(t).collect()}
    assert gap == {2022: None, 2023: 200.0}


# -- segmentation ------------------------------------------------------------------------------

def seven(spark):
    return make(spark, customers=CUSTOMERS, orders=[
        {"order_id": i, "customer_id": i, "order_date": date(2024, i, 1),
         "total_amount": Decimal(i * 10)} for i in range(1, 8)])


def test_orientations_are_opposite(spark):
    t = seven(spark)
    written = {r["customer_id"]: r for r in rfm.rfm_customers(t).collect()}
    best = {r["customer_id"]: r for r in
            rfm.rfm_customers(t, orientation="best_high").collect()}
    assert written[7]["r_score"] == 1 and best[7]["r_score"] == 5
    assert [written[i]["f_score"] for i in range(1, 8)] == [1, 1, 2, 2, 3, 4, 5]
    assert all(written[i][s] + best[i][s] == 6 for i in written
               for s in ("r_score", "f_score", "m_score"))
    assert written[7]["rfm_cell"] == "151"


def test_unknown_orientation(spark):
    with pytest.raises(ValueError):
        rfm.rfm_customers(seven(spark), orientation="sideways")


def test_quantile_scores(spark):
    got = {r["customer_id"]: r for r in
           rfm.rfm_quantile(seven(spark)).collect()}
    assert [got[i]["m"] for i in range(1, 8)] == [1, 1, 2, 3, 4, 5, 5]
    assert [got[i]["r"] for i in range(1, 8)] == [1, 1, 2, 3, 4, 5, 5]
    assert got[7]["segment"] == "Champions" and got[1]["segment"] == "Lost"


def test_pareto(spark):
    got = one(rfm.pareto_share(seven(spark)))
    assert (got["top_customers"], got["top_revenue"]) == (2, 130.0)


# -- cohorts, baskets --------------------------------------------------------------------------

def test_cohort_diagonal_is_complete(spark):
    t = make(spark, orders=[
        {"order_id": 1, "customer_id": 1, "order_date": date(2024, 1, 3)},
        {"order_id": 2, "customer_id": 2, "order_date": date(2024, 1, 9)},
        {"order_id": 3, "customer_id": 1, "order_date": date(2024, 3, 1)},
        {"order_id": 4, "customer_id": 1, "order_date": date(2024, 3, 2)}])
    got = {(r["cohort_month"], r["order_month"]): (r["active_customers"], r["retention_pct"])
           for r in cohorts.cohort_retention(t, limit=None).collect()}
    assert got == {("2024-01", "2024-01"): (2, 100.0), ("2024-01", "2024-03"): (1, 50.0)}


def test_one_new_order_when_two_share_the_first_day(spark):
    t = make(spark, orders=[
        {"order_id": 7, "total_amount": Decimal("5")}, {"order_id": 3, "total_amount": Decimal("8")},
        {"order_id": 9, "order_date": date(2024, 2, 1), "total_amount": Decimal("1")}])
    got = {r["customer_type"]: (r["orders"], r["revenue"])
           for r in cohorts.new_vs_repeat(t).collect()}
    assert got == {"New Customer": (1, 8.0), "Repeat Customer": (2, 6.0)}


def test_basket_pairs_are_directed(spark):
    t = make(spark, products=PRODUCTS, order_items=[
        {"item_id": 1, "order_id": 1, "product_id": 1},
        {"item_id": 2, "order_id": 1, "product_id": 2},
        {"item_id": 3, "order_id": 1, "product_id": 1},
        {"item_id": 4, "order_id": 2, "product_id": 2}])
    got = {(a, b): n for a, b, n in rows(basket.category_basket_pairs(t))}
    assert got == {("Home", "Books"): 1, ("Home", "Home"): 1, ("Books", "Home"): 1}


# -- statistics --------------------------------------------------------------------------------

@pytest.mark.parametrize("t_value, free, p", [
    (2.228, 10, 0.05), (12.706, 1, 0.05), (1.96, 1_000_000, 0.05), (1.96, 10 ** 9, 0.05),
    (3.169, 10, 0.01), (0.0, 5, 1.0)])
def test_t_table(spark, t_value, free, p):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(t_value, float(free))], "t double, free double")
    got = one(df.select(t_two_sided(F.col("t"), F.col("free")).alias("p")))["p"]
    assert got == pytest.approx(p, abs=2e-4)


def test_pooled_ttest(spark):
    t = make(spark, customers=[{"customer_id": 1, "segment": "Premium"},
                               {"customer_id": 2, "segment": "Regular"}],
             orders=[{"order_id": i, "customer_id": c, "total_amount": Decimal(a)} for i, (c, a) in
                     enumerate([(1, 10), (1, 12), (1, 14), (2, 20), (2, 22), (2, 24)], 1)])
    got = one(stats.segment_ttest(t))
    assert (got["mean_a"], got["mean_b"], got["n_a"]) == (12.0, 22.0, 3)
    assert got["t_stat"] == pytest.approx(-10 / math.sqrt(4 * 2 / 3), abs=1e-6)
    assert got["verdict"] == "Significant"


def test_ttest_without_variance(spark):
    t = make(spark, orders=[{"order_id": 1, "discount_pct": 0.0}, {"order_id": 2,
                                                                   "discount_pct": 0.1}])
    got = one(stats.discount_ttest(t))
    assert got["t_stat"] is None and got["p_value"] is None and got["verdict"] is None


def test_describe_and_box(spark):
    t = make(spark, customers=CUSTOMERS, orders=orders(1, 2, 3, 4, 100))
    got = one(stats.order_value_describe(t))
    assert (got["p25"], got["p50"], got["p75"], got["max"]) == (2.0, 3.0, 4.0, 100.0)
    box = one(stats.order_value_box_by_segment(t))
    assert (box["whisker_low"], box["whisker_high"], box["outliers"]) == (1.0, 4.0, 1)


def test_histogram_keeps_every_row(spark):
    t = make(spark, orders=orders(*range(0, 81)))
    got = stats.order_value_histogram(t).orderBy("bin").collect()
    assert [r["orders"] for r in got] == [2] * 39 + [3]
    assert got[0]["median"] == 40.0


def test_density_integrates_to_about_one(spark):
    t = make(spark, orders=orders(*[50 + (i % 21) - 10 for i in range(400)]))
    got = stats.order_value_density(t).orderBy("point").collect()
    step = got[1]["x"] - got[0]["x"]
    assert 0.85 < sum(r["density"] for r in got) * step < 1.05


def test_correlation_matrix_is_lower_triangle(spark):
    t = seven(spark)
    got = stats.customer_correlations(t).collect()
    assert len(got) == 6
    assert all(r["row_feature"] != r["column_feature"] for r in got)


def test_regression_recovers_planted_coefficients(spark):
    # One order per customer: revenue equals the average order value.
    people = [{"customer_id": i, "email": str(i), "segment": ["Premium", "Budget"][i % 2]}
              for i in range(1, 121)]
    t = make(spark, customers=people, orders=[
        {"order_id": i * 10 + k, "customer_id": i, "discount_pct": (i % 5) / 20,
         "total_amount": Decimal(50 + 7 * ((i * 37) % 11))}
        for i in range(1, 121) for k in range(2 + i % 2 * 0)])
    got = {r["metric"]: r["value"] for r in model.clv_regression(t).collect()}
    assert got["coef_aov"] == pytest.approx(2.0, abs=1e-3)
    assert got["r2"] == pytest.approx(1.0, abs=1e-6)
    assert got["train_rows"] + got["test_rows"] == 120


# -- measures ----------------------------------------------------------------------------------

def sales(spark):
    return make(
        spark, customers=[{"customer_id": 1, "segment": "Premium"},
                          {"customer_id": 2, "segment": "Budget"}], products=PRODUCTS,
        orders=[{"order_id": 1, "customer_id": 1, "total_amount": Decimal("20")},
                {"order_id": 2, "customer_id": 2, "channel": "Mobile App"},
                {"order_id": 3, "customer_id": 2, "status": "Returned",
                 "order_date": date(2023, 5, 5)}],
        order_items=[{"item_id": 1, "order_id": 1, "product_id": 1},
                     {"item_id": 2, "order_id": 1, "product_id": 2},
                     {"item_id": 3, "order_id": 2, "product_id": 2},
                     {"item_id": 4, "order_id": 3, "product_id": 1}],
        returns=[{"return_id": 1, "order_id": 3}])


@pytest.mark.parametrize("slicers, kept", [
    (Slicers(), {1, 2, 3}), (Slicers(years=(2023,)), {3}),
    (Slicers(date_from=date(2023, 6, 1)), {1, 2}), (Slicers(date_to=date(2023, 6, 1)), {3}),
    (Slicers(segments=("Budget",)), {2, 3}), (Slicers(categories=("Home",)), {1, 3}),
    (Slicers(statuses=("Returned",)), {3}), (Slicers(channels=("Mobile App",)), {2}),
    (Slicers(states=("Goa",)), set()),
    (Slicers(segments=("Budget",), categories=("Books",)), {2})])
def test_slicers(spark, slicers, kept):
    t = sliced(sales(spark), slicers)
    assert {r[0] for r in t.orders("order_id").collect()} == kept
    assert {r[0] for r in t.order_items("order_id").collect()} == kept
    assert {r[0] for r in t.returns("order_id").collect()} == kept & {3}
    done = {r[0] for r in t.orders("order_id", statuses=["Delivered"]).collect()}
    assert done == kept - {3}


def test_category_slicer_narrows_lines_too(spark):
    t = sliced(sales(spark), Slicers(categories=("Home",)))
    assert [r["category"] for r in overview.category_performance(t).collect()] == ["Home"]
    assert t.order_items().columns == sales(spark).order_items().columns


def test_measures_by_dimension(spark):
    t = sales(spark)
    assert dict(rows(measures.total_revenue(t, ["segment"]))) == {"Premium": 20.0, "Budget": 10.0}
    assert one(measures.clv(t))["clv"] == 15.0
    nothing = sliced(t, Slicers(states=("Goa",)))
    assert one(measures.aov(nothing))["aov"] == 0.0
    assert one(measures.clv(nothing))["clv"] == 0.0
    assert one(measures.return_rate_status(nothing))["return_rate"] == 0.0


def test_drill_through(spark):
    got = topn.product_margin_table(sales(spark), category="Books").collect()
    assert [r["product_id"] for r in got] == [2]


# -- report ------------------------------------------------------------------------------------

@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_export_round_trip(spark, tmp_path, kind):
    from tradelens.sources.tables import Tables
    t = sales(spark)
    for _ in range(2):  # the second write replaces the first
        report.export_tables(t, str(tmp_path), kind)
    back = getattr(Tables, f"from_{kind}")(spark, str(tmp_path))
    for name in ("customers", "products", "orders", "order_items", "returns"):
        assert sorted(rows(back.table(name)), key=str) == sorted(rows(t.table(name)), key=str)
        assert back.table(name).columns == t.table(name).columns


def test_report_sections_are_written(spark, tmp_path):
    t = sales(spark)
    report.write_report(report.dashboard(t), str(tmp_path), "csv")
    for name in report.dashboard(t):
        assert spark.read.option("header", True).csv(f"{tmp_path}/{name}").count() > 0
    with pytest.raises(ValueError):
        report.export_tables(t, str(tmp_path), "xlsx")


@pytest.mark.parametrize("name, sections", [("sql", 29), ("eda", 25), ("dashboard", 7)])
def test_command_line(spark, tmp_path, name, sections):
    from tradelens.__main__ import main
    report.export_tables(sales(spark), f"{tmp_path}/in", "csv")
    main(["--source", f"{tmp_path}/in", "--format", "csv", "--report", name,
          "--reference-date", "2024-06-01", "--out", f"{tmp_path}/out"])
    written = sorted(p.name for p in (tmp_path / "out").iterdir())
    assert len(written) == sections
    for section in written:
        assert spark.read.parquet(f"{tmp_path}/out/{section}").columns


def test_settled_orders_change_nothing(spark):
    t = sales(spark)
    settled = report.SettledOrders(t)
    for name, section in report.dashboard(settled).items():
        assert sorted(rows(section), key=str) == sorted(rows(report.dashboard(t)[name]), key=str)


def test_catalog_tables_join_without_shuffle(spark):
    from tradelens.sources.tables import Tables
    t = sales(spark)
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    for _ in range(2):
        report.save_tables(t, "shop")
    back = Tables.from_catalog(spark, "shop")
    assert sorted(rows(back.returns()), key=str) == sorted(rows(t.returns()), key=str)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = back.order_items("order_id", "quantity").join(back.orders("order_id"), "order_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.sql("DROP DATABASE shop CASCADE")


# -- empty input -------------------------------------------------------------------------------

EMPTY_SAFE = [
    quality.null_audit, quality.order_outliers, quality.constraint_report, quality.table_profile,
    quality.sample_orders, quality.numbered_lines, overview.orders_by_status,
    overview.revenue_by_category, overview.kpi_overview, overview.kpi_overview_as_written,
    overview.gross_margin, overview.return_rate, overview.clv_by_segment, overview.discount_bands,
    overview.headline_stats, overview.category_margin, overview.category_performance,
    overview.dashboard_kpis, overview.state_analysis, trends.order_calendar, trends.order_detail,
    trends.monthly_revenue, trends.mom_growth, trends.monthly_with_index, trends.yoy_growth,
    trends.mom_growth_calendar, trends.year_quarter_matrix, trends.q4_vs_q1,
    rfm.rfm_customers, rfm.rfm_segments_ntile, rfm.rfm_quantile, rfm.rfm_segment_summary,
    rfm.customer_kpis, rfm.pareto_share, cohorts.cohort_retention, cohorts.new_vs_repeat,
    topn.top_products_revenue, topn.top_customers, topn.product_return_rate, topn.product_kpis,
    topn.state_concentration, topn.category_margin_rank, basket.category_basket_pairs,
    stats.order_value_describe, stats.order_value_histogram, stats.order_value_density,
    stats.order_value_box_by_segment, stats.customer_correlations, stats.orders_revenue_trend,
    stats.normality_check, stats.segment_ttest, stats.discount_ttest, stats.pearson_test,
    model.clv_regression, measures.page_cards, report.data_dictionary]


@pytest.mark.parametrize("analysis", EMPTY_SAFE, ids=lambda f: f.__name__)
def test_empty_tables(spark, analysis):
    df = analysis(make(spark))
    assert df.columns
    df.collect()


def test_rounding_has_no_upper_limit(spark):
    from pyspark.sql import functions as F

    from tradelens.functions.numeric import half_up
    row = spark.range(1).select(
        half_up(F.lit(1e17), 3).alias("a"), half_up(F.lit(-2.5e13), 6).alias("b"),
        half_up(F.lit(2.345e5), 2).alias("c"), half_up(F.lit(-0.5), 0).alias("d"),
        half_up(F.lit(1e300), 4).alias("e"), half_up(F.lit(None).cast("double"), 2).alias("f")).first()
    assert tuple(row) == (1e17, -2.5e13, 234500.0, -1.0, 1e300, None)


@pytest.mark.parametrize("free", [1.0, 5.0, 99.0, 250.0, 1e4, 1e6, 1e7 + 1, 1e9])
def test_p_values_by_integration(spark, free):
    """One formula for all degrees of freedom, against the integral of the density."""
    import numpy as np
    from pyspark.sql import functions as F

    from tradelens.functions.student_t import t_two_sided
    ts = [0.0, 1e-6, 0.1, 0.7, 1.96, 3.3, 5.0]
    got = [r[0] for r in spark.createDataFrame([(t, free) for t in ts], "t double, n double")
           .coalesce(1).select(t_two_sided(F.col("t"), F.col("n"))).collect()]
    for t, p in zip(ts, got):
        grid = np.linspace(0.0, t, 200_001)
        density = np.exp(-(free + 1) / 2 * np.log1p(grid * grid / free))
        half = np.sqrt(np.pi) / 2  # normal curve's half integral, corrected by gamma's half step
        step = 0.5 * np.log(free / 2) - 1 / (4 * free) + 1 / (24 * free**3) if free > 50 else \
            __import__("math").lgamma((free + 1) / 2) - __import__("math").lgamma(free / 2)
        scale = np.exp(step) / np.sqrt(free * np.pi)
        inside = 2 * scale * np.trapezoid(density, grid)
        assert abs((1 - inside) - p) < 1e-9 and half > 0


def test_orders_of_unknown_customers_are_not_lost(spark, tmp_path):
    """Rows do not depend on the columns asked for; keys of long orders do not collide."""
    import duckdb

    from tradelens.plans import quality, topn, trends
    from tradelens.sources.bound import StarTables
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("nation", "part", "orders"):
        con.execute(f"COPY (FROM '{folder}/{name}.parquet') TO '{tmp_path}/{name}.parquet'")
    con.execute(f"COPY (FROM '{folder}/customer.parquet' WHERE c_custkey % 10 <> 0) "
                f"TO '{tmp_path}/customer.parquet'")
    con.execute(f"""COPY (FROM '{folder}/lineitem.parquet' UNION ALL BY NAME
        SELECT l.* REPLACE (1::BIGINT AS l_orderkey, (100 + i)::INTEGER AS l_linenumber) FROM range(1500) r(i),
               (FROM '{folder}/lineitem.parquet' LIMIT 1) l) TO '{tmp_path}/lineitem.parquet'""")
    tables = StarTables(spark, str(tmp_path))
    n = tables.orders("status").count()
    assert tables.orders("state").count() == trends.order_calendar(tables).count() == n
    assert None in {r["state"] for r in topn.top_states(tables, limit=99).collect()}
    items = tables.order_items("item_id")
    assert items.distinct().count() == items.count()
    found = {tuple(r)[:3]: r for r in quality.constraint_report(tables).collect()}
    assert not [r for k, r in found.items() if "primary_key" in k and r["violations"]]
    assert [r for k, r in found.items() if "foreign_key" in str(k) and r["violations"]]
