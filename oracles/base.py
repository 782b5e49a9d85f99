"""Building blocks of the comparison SQL: the canonical tables and rounding, as DuckDB text."""

from __future__ import annotations

# The canonical tables as CTEs over the test tables. Only the ones a query names are evaluated.
BINDING = """
WITH cust AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         CASE WHEN c_custkey % 50 <> 0
              THEN concat('customer', CAST(c_custkey AS VARCHAR), '@example.com') END AS email,
         n_name AS city, n_name AS state, c_mktsegment AS segment
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
prod AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
         p_retailprice AS unit_price, CAST(p_retailprice AS DECIMAL(12,2)) AS cost_price
  FROM part),
line AS (
  SELECT CAST(CAST(l_orderkey AS HUGEINT) * 1000000000000000000 + row_number() OVER (
           PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
                                            l_extendedprice, l_quantity)
              AS DECIMAL(38,0)) AS item_id,
         l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
         l_extendedprice / l_quantity AS unit_price, l_discount AS discount_pct,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2))
              * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2)))
              AS DECIMAL(18,4)) AS line_revenue
  FROM lineitem),
line_total AS (
  SELECT order_id, CAST(round(sum(line_revenue), 2) AS DECIMAL(18,2)) AS total_amount
  FROM line GROUP BY order_id),
raw_ord AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         CASE o_orderstatus
           WHEN 'F' THEN 'Delivered'
           WHEN 'O' THEN CASE WHEN o_orderkey % 3 = 0 THEN 'Cancelled' ELSE 'Shipped' END
           WHEN 'P' THEN CASE WHEN o_orderkey % 3 = 0 THEN 'Returned' ELSE 'Processing' END
         END AS status,
         o_orderpriority AS payment_mode,
         CASE WHEN o_orderkey % 10 < 5 THEN 'Mobile App'
              WHEN o_orderkey % 10 < 9 THEN 'Website' ELSE 'Mobile Web' END AS channel,
         (o_custkey % 5) * 5 / CAST(100 AS DOUBLE) AS discount_pct,
         t.total_amount, c.city, c.state
  FROM orders LEFT JOIN cust c ON o_custkey = c.customer_id
       LEFT JOIN line_total t ON t.order_id = o_orderkey),
ord AS (SELECT * REPLACE (coalesce(total_amount, 0) AS total_amount) FROM raw_ord),
done AS (SELECT * FROM ord WHERE status = 'Delivered'),
ret AS (
  SELECT order_id AS return_id, order_id,
         order_date + CAST(1 + customer_id % 15 AS INTEGER) AS return_date,
         ['Defective product', 'Wrong item delivered', 'Changed mind', 'Better price elsewhere',
          'Not as described', 'Damaged packaging'][customer_id % 6 + 1] AS reason
  FROM raw_ord WHERE status = 'Returned'),
sold AS (
  SELECT line.*, prod.category, prod.cost_price, prod.product_name, prod.brand
  FROM done JOIN line USING (order_id) JOIN prod USING (product_id)),
buyer AS (
  SELECT customer_id, count(DISTINCT order_id) AS orders, sum(total_amount) AS spent,
         max(order_date) AS last_order_date, avg(discount_pct) AS avg_discount
  FROM done GROUP BY customer_id)
"""


def query(body: str, *ctes: str) -> str:
    """``body`` on top of the canonical tables and further CTEs."""
    return BINDING + "".join(f", {cte}" for cte in ctes) + body


def real(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def half_up(x: str, digits: int) -> str:
    scale = f"CAST(1e{digits} AS DOUBLE)"
    return f"(sign({real(x)}) * floor(abs({real(x)}) * {scale} + 0.5) / {scale})"


def money(x: str, digits: int = 2) -> str:
    return real(f"round({x}, {digits})")


def ratio(top: str, bottom: str, digits: int, scale: str = "1") -> str:
    return half_up(f"({real(scale)} * {real(top)} / nullif({real(bottom)}, 0))", digits)


def percent(top: str, bottom: str, digits: int) -> str:
    return ratio(top, bottom, digits, "100")


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def mean(x: str, digits: int = 2) -> str:
    return ratio(f"sum({x})", f"count({x})", digits)
