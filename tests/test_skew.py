"""Hot keys: a third of the lines in one order, a third of one product, a third of one customer.

Broadcasts are off and the size limits low, so the joins shuffle and the distributed forms of
ranks, numbering and quantiles run; DuckDB has the last word.
"""

from __future__ import annotations


import duckdb
import pytest

import __spark_entry__ as driver
from tests.compare import connect, differences

LINES, ORDERS = 24_000, 3_000

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.files.maxPartitionBytes": "60KB",  # several map tasks, or nothing can be split
    "spark.sql.files.openCostInBytes": "1KB",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("skew")
    con = duckdb.connect()

    def save(name, sql):
        con.execute(f"COPY ({sql}) TO '{out}/{name}.parquet' (FORMAT parquet, ROW_GROUP_SIZE 2048)")

    for name in ("nation", "customer", "part"):
        save(name, f"SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    save("orders", f"""
        SELECT CAST(i AS BIGINT) AS o_orderkey,
               CAST(CASE WHEN i % 3 = 0 THEN 7 ELSE hash(i) % 150 END AS BIGINT) AS o_custkey,
               ['F', 'F', 'F', 'O', 'P'][CAST(hash(i + 1) % 5 AS INTEGER) + 1] AS o_orderstatus,
               TIMESTAMP '1995-01-01' + INTERVAL 1 DAY * CAST(hash(i + 2) % 2400 AS INTEGER)
                 AS o_orderdate,
               '1-URGENT' AS o_orderpriority
        FROM range({ORDERS}) t(i)""")
    save("lineitem", f"""
        SELECT CAST(CASE WHEN i % 3 = 0 THEN 4 ELSE hash(i) % {ORDERS} END AS BIGINT)
                 AS l_orderkey,
               CAST(CASE WHEN i % 3 = 1 THEN 11 ELSE hash(i + 5) % 200 END AS BIGINT) AS l_partkey,
               CAST(i AS BIGINT) AS l_suppkey,
               CAST(1 + hash(i + 3) % 7 AS INTEGER) AS l_linenumber,
               CAST(1 + hash(i + 6) % 50 AS DOUBLE) AS l_quantity,
               CAST(round(900 + (hash(i + 7) % 9000000) / 100.0, 2) AS DOUBLE) AS l_extendedprice,
               CAST(round((hash(i + 8) % 11) / 100.0, 2) AS DOUBLE) AS l_discount,
               TIMESTAMP '2000-01-01' AS l_shipdate
        FROM range({LINES}) t(i)""")
    return str(out)


@pytest.fixture(scope="module")
def shuffled(spark):
    before = {key: spark.conf.get(key, None) for key in CONF}
    for key, value in CONF.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


HOT = ["numbered_lines", "rfm_customers_as_written", "rfm_quantile", "pareto_share",
       "order_value_describe", "order_value_box_by_segment",
       "revenue_by_category", "gross_margin", "kpi_overview_as_written", "headline_stats",
         "clv_by_segment", "clv_by_state", "state_analysis", "cohort_retention_full",
         "new_vs_repeat", "top_products_revenue", "top_customers", "product_return_rate",
         "category_return_rate", "category_basket_pairs_all", "constraint_report",
         "orders_without_items", "orphan_items", "order_detail", "duplicate_lines",
         "customer_features", "sliced_category_revenue"]


@pytest.mark.parametrize("name", HOT)
def test_hot_keys(shuffled, folder, name):
    mine = driver.queries()[name](shuffled, folder)
    theirs = connect(folder).sql(driver.oracle_sql()[name]).to_arrow_table()
    assert differences(mine.toArrow(), theirs) == []


def test_hot_partition_is_split(shuffled, folder):
    df = driver.queries()["gross_margin"](shuffled, folder)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
