"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in driver.queries().items() if name in driver.ANALYSES}

# Tests with a p-value end in a Python function on one row.
PYTHON = {"segment_ttest", "discount_ttest", "pearson_test"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_stray_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert ("ArrowEvalPython" in text) == (name in PYTHON)
    assert "BatchEvalPython" not in text and "InArrow" not in text and "InPandas" not in text


def scans(text: str) -> int:
    """File scans of the plan without adaptive changes."""
    return len(re.findall(r"FileScan ", text.split("== Initial Plan ==")[-1]))


@pytest.mark.parametrize("name, most", [("constraint_report", 8), ("rfm_quantile", 6), ("rfm_report", 7),
                                        ("rfm_customers_as_written", 6), ("order_value_histogram", 1),
                                        ("order_value_box_by_segment", 1), ("clv_regression", 10)])
def test_tables_are_not_read_again_and_again(spark, name, most):
    """What is written on the way counts too; passes that ended while the plan was built do not."""
    assert scans(plan(QUERIES[name](spark, FOLDER))) <= most


@pytest.mark.parametrize("name", ["revenue_by_category", "monthly_revenue", "top_customers",
                                  "new_vs_repeat", "order_outliers"])
def test_status_reaches_the_scan(spark, name):
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(o_orderstatus,F\)",
                     plan(QUERIES[name](spark, FOLDER)))


def test_scans_read_only_what_is_used(spark):
    text = plan(QUERIES["orders_by_weekday"](spark, FOLDER))
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert "o_orderkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz" in schemas
    assert "l_orderkey:bigint,l_extendedprice:double,l_discount:double" in schemas
    assert len(schemas) == 2  # neither customers nor products


def test_status_report_does_not_touch_the_lines(spark):
    assert "l_orderkey" not in plan(QUERIES["orders_by_status"](spark, FOLDER))


def test_first_order_uses_hash_aggregates(spark):
    assert "SortAggregate" not in plan(QUERIES["new_vs_repeat"](spark, FOLDER))


def lines_shuffled(text: str) -> int:
    """Exchanges above a scan of the lines, in the plan without adaptive changes."""
    count, depths = 0, []
    for line in text.split("== Initial Plan ==")[-1].splitlines():
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        while depths and depths[-1][0] >= depth:
            depths.pop()
        if "Exchange" in line:
            depths.append((depth, "Exchange"))
        if "l_orderkey" in line and "FileScan" in line:
            count = max(count, len(depths))
    return count


@pytest.mark.parametrize("name, most", [("revenue_by_category", 4), ("category_margin", 4),
                                        ("product_return_rate", 4), ("category_return_rate", 3),
                                        ("gross_margin", 3)])
def test_lines_are_shuffled_no_more_than_needed(spark, name, most):
    """On the lines' way to the result; those of sums, of the top rows and of the sort included."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert lines_shuffled(plan(QUERIES[name](spark, FOLDER))) <= most
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_cube_takes_a_customer_through_all_sets_in_one_task(spark, monkeypatch):
    """What is multiplied by the sets is not shuffled again by customer, and tasks follow the rows."""
    monkeypatch.setattr("tradelens.session.GROUPED_ROWS", 1000)
    orders = driver.StarTables(spark, FOLDER).row_count("orders")
    text = plan(QUERIES["slicer_cube"](spark, FOLDER))
    above = text.split("Generate")[0]
    assert "Expand" not in text and above.count("Exchange") == 1 and "customer_id" not in \
        re.search(r"Exchange hashpartitioning\(([^)]*)\)", above)[1]
    assert re.search(rf"hashpartitioning\(customer_id#\d+L, {-(-orders * 32 // 1000)}\)", text)


@pytest.mark.parametrize("name", ["product_return_rate", "category_return_rate"])
def test_return_rates_deal_a_bounded_number_of_lines(spark, monkeypatch, name):
    monkeypatch.setattr("tradelens.session.GROUPED_ROWS", 1000)
    lines = driver.StarTables(spark, FOLDER).row_count("order_items")
    assert re.search(rf"hashpartitioning\(order_id#\d+L, {-(-lines // 1000)}\), REPARTITION_BY_NUM",
                     plan(QUERIES[name](spark, FOLDER)))
