"""Comparison SQL for preparation, quality, overview and trend reports."""

from __future__ import annotations

from oracles.base import big, half_up, mean, money, percent, query, ratio, real


def _value(keys: str, source: str = "done", names=("orders", "revenue", "aov")) -> str:
    n, revenue, aov = names
    return query(f"""
SELECT {keys}, count(*) AS {n}, {money('sum(total_amount)')} AS {revenue},
       {mean('total_amount')} AS {aov} FROM {source} GROUP BY ALL""")


QUALITY = {
    "null_audit": query("""
SELECT 'customers' AS tbl, count(*) FILTER (email IS NULL) AS null_email,
       count(*) FILTER (city IS NULL) AS null_city,
       count(*) FILTER (segment IS NULL) AS null_segment FROM cust
UNION ALL
SELECT 'orders', count(*) FILTER (total_amount IS NULL), count(*) FILTER (payment_mode IS NULL),
       count(*) FILTER (channel IS NULL) FROM raw_ord"""),
    "null_counts": query("""
SELECT 'customers' AS tbl, 'email' AS "column", count(*) - count(email) AS nulls FROM cust
UNION ALL SELECT 'customers', 'city', count(*) - count(city) FROM cust
UNION ALL SELECT 'customers', 'segment', count(*) - count(segment) FROM cust
UNION ALL SELECT 'orders', 'total_amount', count(*) - count(total_amount) FROM raw_ord
UNION ALL SELECT 'orders', 'payment_mode', count(*) - count(payment_mode) FROM raw_ord
UNION ALL SELECT 'orders', 'channel', count(*) - count(channel) FROM raw_ord"""),
    "fill_null_totals": query(f"SELECT order_id, {money('total_amount')} AS total_amount FROM ord"),
    "order_outliers": query(f"""
SELECT order_id, {money('total_amount')} AS total_amount, {half_up('z', 2)} AS z_score
FROM (SELECT *, ({real('total_amount')} - avg({real('total_amount')}) OVER ())
             / nullif(stddev_pop({real('total_amount')}) OVER (), 0) AS z FROM done)
WHERE abs(z) > 3"""),
    "duplicate_orders": query(
        "SELECT order_id, count(*) AS cnt FROM raw_ord GROUP BY order_id HAVING count(*) > 1"),
    "duplicate_lines": query("""
SELECT order_id, product_id, count(*) AS cnt FROM line
GROUP BY order_id, product_id HAVING count(*) > 1"""),
    "orphan_items": query("SELECT item_id, order_id FROM line ANTI JOIN raw_ord USING (order_id)"),
    "orders_without_items": query("SELECT order_id FROM raw_ord ANTI JOIN line USING (order_id)"),
    "order_totals": query(f"""
SELECT o.order_id, coalesce({money('sum(l.line_revenue)')}, 0) AS total_amount
FROM raw_ord o LEFT JOIN line l USING (order_id) GROUP BY o.order_id"""),
    "line_revenue": query(f"""
SELECT order_id, product_id, quantity,
       {money('CAST(quantity * unit_price AS DECIMAL(18,4)) * (CAST(1 AS DECIMAL(5,4)) - CAST(discount_pct AS DECIMAL(5,4)))')}
         AS computed_revenue, {real('line_revenue')} AS line_revenue FROM line"""),
    "returned_orders": query("""
SELECT o.order_id, o.customer_id, o.order_date, r.return_date,
       CAST(r.return_date - o.order_date AS BIGINT) AS days_to_return
FROM raw_ord o LEFT JOIN ret r ON r.order_id = o.order_id WHERE o.status = 'Returned'"""),
    "numbered_lines": query("""
SELECT order_id, product_id,
       row_number() OVER (PARTITION BY order_id ORDER BY product_id) AS line_no
FROM (SELECT DISTINCT order_id, product_id FROM line)"""),
    "sample_orders": query(f"""
SELECT order_id, {money('total_amount')} AS total_amount FROM (
  SELECT order_id, total_amount,
         (((((order_id % 2147483647) * 48271 + 42) % 2147483647)
           * (((order_id % 2147483647) * 48271 + 42) % 2147483647)) % 2147483647
          * 69621 + 42) % 2147483647 AS h FROM done)
ORDER BY h, order_id LIMIT 200"""),
    "table_profile": query("""
SELECT 'customers' AS "table", count(*) AS rows, CAST(7 AS BIGINT) AS columns,
       count(*) * 6 - count(first_name) - count(last_name) - count(email) - count(city)
       - count(state) - count(segment) AS nulls FROM cust
UNION ALL SELECT 'products', count(*), 6, count(*) * 5 - count(product_name) - count(category)
       - count(brand) - count(unit_price) - count(cost_price) FROM prod
UNION ALL SELECT 'orders', count(*), 10, count(*) * 9 - count(customer_id) - count(order_date)
       - count(status) - count(payment_mode) - count(channel) - count(discount_pct)
       - count(total_amount) - count(city) - count(state) FROM raw_ord
UNION ALL SELECT 'order_items', count(*), 7, count(*) * 6 - count(order_id) - count(product_id)
       - count(quantity) - count(unit_price) - count(discount_pct) - count(line_revenue) FROM line
UNION ALL SELECT 'returns', count(*), 4, count(*) * 3 - count(order_id) - count(return_date)
       - count(reason) FROM ret"""),
}


def _constraints() -> str:
    rows = []

    def add(rule, table, column, sql):
        rows.append(f"SELECT '{rule}' AS rule, '{table}' AS \"table\", '{column}' AS \"column\", "
                    f"{big(f'({sql})')} AS violations")

    source = {"customers": "cust", "products": "prod", "orders": "raw_ord",
              "order_items": "line", "returns": "ret"}
    required = {
        "customers": ["customer_id", "first_name", "last_name", "email"],
        "products": ["product_id", "product_name", "category", "unit_price", "cost_price"],
        "orders": ["order_id", "customer_id", "order_date"],
        "order_items": ["item_id", "order_id", "product_id", "quantity", "unit_price",
                        "line_revenue"],
        "returns": ["return_id", "order_id", "return_date"],
    }
    for table, columns in required.items():
        for c in columns:
            add("not_null", table, c, f"SELECT count(*) FROM {source[table]} WHERE {c} IS NULL")
    add("allowed_values", "customers", "segment",
        "SELECT count(*) FROM cust WHERE segment NOT IN ('Premium', 'Regular', 'Budget')")
    add("allowed_values", "orders", "status",
        "SELECT count(*) FROM raw_ord WHERE status NOT IN "
        "('Delivered', 'Shipped', 'Cancelled', 'Returned', 'Processing')")
    for table, c in (("products", "unit_price"), ("products", "cost_price"),
                     ("order_items", "quantity")):
        add("positive", table, c, f"SELECT count(*) FROM {source[table]} WHERE NOT {c} > 0")
    for table, c, rule in (("customers", "customer_id", "primary_key"),
                           ("products", "product_id", "primary_key"),
                           ("orders", "order_id", "primary_key"),
                           ("order_items", "item_id", "primary_key"),
                           ("returns", "return_id", "primary_key"),
                           ("customers", "email", "unique")):
        add(rule, table, c, f"SELECT count(*) FROM (SELECT {c} FROM {source[table]} "
            f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
    for child, c, parent in (("orders", "customer_id", "customers"),
                             ("order_items", "order_id", "orders"),
                             ("order_items", "product_id", "products"),
                             ("returns", "order_id", "orders")):
        add("foreign_key", child, c,
            f"SELECT count(*) FROM {source[child]} ANTI JOIN {source[parent]} USING ({c})")
    add("sum_of_lines", "orders", "total_amount",
        "SELECT count(*) FROM ord LEFT JOIN (SELECT order_id, round(sum(line_revenue), 2) AS s "
        "FROM line GROUP BY order_id) USING (order_id) WHERE total_amount <> coalesce(s, 0)")
    add("days_after_order", "returns", "return_date",
        "SELECT count(*) FROM ret JOIN raw_ord USING (order_id) "
        "WHERE return_date - order_date NOT BETWEEN 1 AND 15")
    add("line_amount", "order_items", "line_revenue",
        "SELECT count(*) FROM line WHERE abs(CAST(line_revenue AS DOUBLE) "
        "- quantity * unit_price * (1 - discount_pct)) > 0.01")
    add("order_discount", "order_items", "discount_pct",
        "SELECT count(DISTINCT order_id) FROM line JOIN ord o USING (order_id) "
        "WHERE round(line.discount_pct * 100) <> round(o.discount_pct * 100)")
    add("of_returned_order", "returns", "order_id",
        "SELECT count(*) FROM ret JOIN raw_ord USING (order_id) WHERE status <> 'Returned'")
    add("one_per_order", "returns", "order_id", "SELECT count(*) FROM (SELECT order_id FROM ret "
        "WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1)")
    for rule, table, c in (("not_null", "customers", "registration_date"),
                           ("allowed_values", "customers", "is_active"),
                           ("allowed_values", "products", "is_active"),
                           ("allowed_values", "returns", "status"),
                           ("after_registration", "orders", "order_date")):
        add(rule, table, c, "SELECT NULL")
    return query("\n" + "\nUNION ALL ".join(rows))


QUALITY["constraint_report"] = _constraints()


def _exported() -> str:
    parts = (("customers", "cust", "customer_id", "customer_id"), ("products", "prod", "product_id", "cost_price"),
             ("orders", "raw_ord", "order_id", "total_amount"), ("order_items", "line", "item_id", "line_revenue"),
             ("returns", "ret", "return_id", "order_id"))
    return query("\n" + "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS rows, count(DISTINCT {key}) AS keys, "
        f"{money(f'sum({amount})')} AS amount FROM {source}" for name, source, key, amount in parts))


QUALITY["exported_tables"] = QUALITY["exported_tables_csv"] = _exported()
QUALITY["stored_totals"] = query(f" SELECT order_id, {money('total_amount')} AS total_amount FROM ord")

_CATEGORY = """cat AS (
  SELECT category, count(DISTINCT order_id) AS orders, sum(quantity) AS units,
         sum(line_revenue) AS revenue, sum(line_revenue) - sum(quantity * cost_price) AS profit,
         avg(unit_price) AS price FROM sold GROUP BY category)"""

_STATE = f"""st AS (
  SELECT state, count(*) AS orders, sum(total_amount) AS spent,
         count(DISTINCT customer_id) AS customers FROM done GROUP BY state)"""

_KNOWN_STATE = _STATE.replace("FROM done", "FROM done WHERE state IS NOT NULL")

_STATE_REPORT = f"""
SELECT state, orders, {money('spent')} AS revenue, customers, {ratio('spent', 'orders', 2)} AS aov,
       {ratio('spent', 'sum(spent) OVER ()', 6)} AS revenue_share,
       CAST(trunc(200 - 150 * ({real('spent')} / {real('max(spent) OVER ()')})) AS INTEGER) AS heat
FROM st"""

_HEAD = f"""head AS (
  SELECT {money("sum(total_amount) FILTER (status = 'Delivered')")} AS total_revenue,
         count(*) FILTER (status = 'Delivered') AS total_orders,
         {ratio("sum(total_amount) FILTER (status = 'Delivered')",
                "count(*) FILTER (status = 'Delivered')", 2)} AS avg_order_value,
         count(DISTINCT customer_id) FILTER (status = 'Delivered') AS unique_customers,
         {percent("count(*) FILTER (status = 'Cancelled')", 'count(*)', 4)} AS cancellation_pct,
         {percent("count(*) FILTER (status = 'Returned')", 'count(*)', 4)} AS return_pct
  FROM ord)"""

_MARGIN = f"""margin AS (
  SELECT {money('sum(line_revenue)')} AS revenue, {money('sum(quantity * cost_price)')} AS cogs,
         {money('sum(line_revenue) - sum(quantity * cost_price)')} AS gross_profit,
         {percent('sum(line_revenue) - sum(quantity * cost_price)', 'sum(line_revenue)', 1)}
           AS gross_margin_pct FROM sold)"""

_RETURN_RATE = f"""rate AS (
  SELECT count(DISTINCT o.order_id) AS delivered_orders,
         count(DISTINCT r.return_id) AS returned_orders,
         {percent('count(DISTINCT r.return_id)', 'count(DISTINCT o.order_id)', 2)}
           AS return_rate_pct
  FROM ord o LEFT JOIN ret r USING (order_id) WHERE o.status IN ('Delivered', 'Returned'))"""

OVERVIEW = {
    "orders_by_status": query(f"""
SELECT status, count(*) AS order_count, {percent('count(*)', 'sum(count(*)) OVER ()', 1)} AS pct
FROM ord GROUP BY status"""),
    "status_counts": query('SELECT status, count(*) AS "count" FROM ord GROUP BY status'),
    "revenue_by_category": query(f"""
SELECT category, orders, {big('units')} AS units_sold, {money('revenue')} AS total_revenue,
       {half_up('price', 2)} AS avg_price FROM cat""", _CATEGORY),
    "customers_by_segment_state": query("""
SELECT segment, state, count(*) AS customers FROM cust GROUP BY segment, state
ORDER BY customers DESC, segment, state LIMIT 20"""),
    "payment_mode_summary": _value("payment_mode", "(SELECT * FROM ord WHERE status <> 'Cancelled')",
                                   ("order_count", "total_gmv", "avg_order_value")),
    "channel_summary": _value("channel"),
    "kpi_overview": query(f"""
SELECT count(*) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
       {money('sum(total_amount)')} AS gross_revenue, {mean('total_amount')} AS avg_order_value,
       {real('(SELECT sum(quantity) FROM sold)')} AS total_units_sold,
       {ratio('sum(total_amount)', 'count(DISTINCT customer_id)', 2)} AS revenue_per_customer
FROM done"""),
    "kpi_overview_as_written": query(f"""
SELECT count(DISTINCT done.order_id) AS total_orders,
       count(DISTINCT done.customer_id) AS unique_customers,
       {money('sum(done.total_amount)')} AS gross_revenue,
       {mean('done.total_amount')} AS avg_order_value,
       {real('sum(line.quantity)')} AS total_units_sold,
       {ratio('sum(done.total_amount)', 'count(DISTINCT done.customer_id)', 2)}
         AS revenue_per_customer
FROM done JOIN line USING (order_id)"""),
    "gross_margin": query(" SELECT * FROM margin", _MARGIN),
    "return_rate": query(" SELECT * FROM rate", _RETURN_RATE),
    "clv_by_segment": query(f"""
SELECT segment, count(*) AS customers, {mean('orders', 1)} AS avg_orders,
       {mean('spent')} AS avg_clv, {money('max(spent)')} AS max_clv
FROM buyer JOIN cust USING (customer_id) GROUP BY segment"""),
    "discount_bands": _value(
        "CASE WHEN discount_pct = 0 THEN 'No Discount' WHEN discount_pct <= 0.1 THEN 'Up to 10%' "
        "WHEN discount_pct <= 0.2 THEN '11-20%' ELSE 'Above 20%' END AS discount_band",
        names=("orders", "total_revenue", "avg_order_value")),
    "headline_stats": query(" SELECT * FROM head", _HEAD),
    "revenue_by_segment": query(f"""
SELECT segment, {money('sum(total_amount)')} AS total_revenue, {mean('total_amount')} AS avg_order,
       count(*) AS orders FROM done JOIN cust USING (customer_id) GROUP BY segment"""),
    "category_margin": query(f"""
SELECT category, {money('revenue')} AS revenue, {money('profit')} AS profit,
       {half_up('m', 4)} AS margin_pct, m < 35 AS below_target,
       {half_up('avg(m) OVER ()', 4)} AS avg_margin_pct
FROM (SELECT *, 100 * {real('profit')} / {real('revenue')} AS m FROM cat)""", _CATEGORY),
    "category_performance": query(f"""
SELECT category, orders, {big('units')} AS units, {money('revenue')} AS revenue,
       {money('profit')} AS profit, {half_up('price', 2)} AS avg_price,
       {ratio('profit', 'revenue', 6)} AS margin,
       {ratio('revenue', 'sum(revenue) OVER ()', 6)} AS revenue_share FROM cat""", _CATEGORY),
    "payment_channel_matrix": query("""
SELECT payment_mode, count(*) FILTER (channel = 'Mobile App') AS "Mobile App",
       count(*) FILTER (channel = 'Website') AS "Website",
       count(*) FILTER (channel = 'Mobile Web') AS "Mobile Web" FROM done GROUP BY payment_mode"""),
    "revenue_by_payment": query(f"""
SELECT payment_mode, {money('sum(total_amount)')} AS revenue FROM done GROUP BY payment_mode"""),
    "dashboard_kpis": query(f"""
SELECT head.*, (SELECT {half_up('100 * avg(discount_pct)', 4)} FROM done) AS avg_discount_pct,
       (SELECT gross_margin_pct FROM margin) AS gross_margin_pct FROM head""", _HEAD, _MARGIN),
    "kpi_tiles": query("""
SELECT unnest(['Total Revenue', 'Total Orders', 'Avg Order Value', 'Unique Customers',
               'Return Rate', 'Cancel Rate', 'Avg Discount', 'Gross Margin']) AS tile,
       unnest(['\u20b9' || format('{:,.0f}', total_revenue), format('{:,}', total_orders),
               '\u20b9' || format('{:,.0f}', avg_order_value), format('{:,}', unique_customers),
               format('{:.1f}%', return_pct), format('{:.1f}%', cancellation_pct),
               format('{:.1f}%', (SELECT 100 * avg(discount_pct) FROM done)),
               format('{:.1f}%', (SELECT gross_margin_pct FROM margin))]) AS value
FROM head""", _HEAD, _MARGIN),
    "state_analysis": query(_STATE_REPORT, _KNOWN_STATE),
    "state_analysis_top8": query(_STATE_REPORT + " ORDER BY revenue DESC, state LIMIT 8", _KNOWN_STATE),
}

_MONTH = """mon AS (
  SELECT date_trunc('month', order_date) AS m, sum(total_amount) AS revenue
  FROM done GROUP BY 1),
lagged AS (
  SELECT m, revenue, lag(revenue) OVER (ORDER BY m) AS before, lag(m) OVER (ORDER BY m) AS m_before
  FROM mon)"""
_GROWTH = f"({real('revenue - before')} / nullif({real('before')}, 0))"
_QUARTER = """qtr AS (
  SELECT CAST(year(order_date) AS INTEGER) AS year, quarter(order_date) AS q,
         count(*) AS orders, sum(total_amount) AS revenue FROM done GROUP BY 1, 2)"""
_MATRIX = "matrix AS (SELECT year, " + ", ".join(
    f"{money(f'sum(revenue) FILTER (q = {q})')} AS \"Q{q}\"" for q in (1, 2, 3, 4)) \
    + " FROM qtr GROUP BY year)"

TRENDS = {
    "order_calendar": query("""
SELECT ord.* REPLACE (CAST(total_amount AS DOUBLE) AS total_amount),
       CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month, strftime(order_date, '%Y-%m') AS year_month,
       concat(year(order_date), 'Q', quarter(order_date)) AS quarter, dayname(order_date) AS dow
FROM ord"""),
    "order_detail": query(f"""
SELECT item_id, order_id, product_id, customer_id, order_date, status, line.discount_pct,
       CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,
       strftime(order_date, '%Y-%m') AS year_month, ord.discount_pct AS order_discount_pct,
       quantity, {half_up('line.unit_price', 4)} AS unit_price, {real('line_revenue')} AS line_revenue,
       product_name, category, brand, {real('cost_price')} AS cost_price,
       {real('line_revenue - quantity * cost_price')} AS profit
FROM line JOIN ord USING (order_id) JOIN prod USING (product_id)"""),
    "monthly_revenue": query(f"""
SELECT strftime(order_date, '%Y') AS year, strftime(order_date, '%m') AS month,
       strftime(order_date, '%Y-%m') AS year_month, count(DISTINCT order_id) AS orders,
       {money('sum(total_amount)')} AS revenue, {mean('total_amount')} AS aov
FROM done GROUP BY ALL"""),
    "mom_growth": query(f"""
SELECT strftime(m, '%Y-%m') AS ym, {money('revenue')} AS revenue, {money('before')} AS prev_revenue,
       {percent('revenue - before', 'before', 1)} AS mom_growth_pct FROM lagged""", _MONTH),
    "monthly_trend": query(f"""
SELECT strftime(m, '%Y-%m') AS year_month, {money('revenue')} AS revenue,
       {half_up(f'{_GROWTH} * 100', 6)} AS mom_growth FROM lagged""", _MONTH),
    "monthly_with_index": query(f"""
SELECT strftime(m, '%Y-%m') AS year_month, {money('revenue')} AS revenue,
       {half_up(f'coalesce({_GROWTH}, 0)', 6)} AS mom_growth,
       {ratio('revenue', 'max(revenue) OVER ()', 6)} AS volume_index FROM lagged""", _MONTH),
    "mom_growth_calendar": query(f"""
SELECT strftime(a.m, '%Y-%m') AS year_month, {money('a.revenue')} AS revenue,
       {half_up(f"coalesce({real('a.revenue - b.revenue')} / nullif({real('b.revenue')}, 0), 0)", 6)}
         AS mom_growth
FROM mon a LEFT JOIN mon b ON a.m = b.m + INTERVAL 1 MONTH""", _MONTH),
    "yoy_growth": query(f"""
SELECT yr, orders, {real('revenue')} AS revenue, aov, unique_customers,
       {percent('revenue - before', 'before', 1)} AS yoy_growth_pct
FROM (SELECT *, lag(revenue) OVER (ORDER BY yr) AS before FROM (
        SELECT strftime(order_date, '%Y') AS yr, count(DISTINCT order_id) AS orders,
               round(sum(total_amount), 2) AS revenue, {mean('total_amount')} AS aov,
               count(DISTINCT customer_id) AS unique_customers FROM done GROUP BY 1))"""),
    "quarterly_performance": query(f"""
SELECT CAST(year AS VARCHAR) AS year, concat('Q', q) AS quarter, orders,
       {money('revenue')} AS revenue FROM qtr""", _QUARTER),
    "category_by_year": query("""
SELECT category, """ + ", ".join(
        money(f"sum(line_revenue) FILTER (year(order_date) = {y})") + f' AS "{y}"'
        for y in range(1995, 2002)) + """
FROM sold JOIN done USING (order_id) GROUP BY category"""),
    "year_quarter_matrix": query(" SELECT * FROM matrix", _QUARTER, _MATRIX),
    "q4_vs_q1": query(f"""
SELECT year, "Q1" AS q1_revenue, "Q4" AS q4_revenue,
       {half_up('("Q4" - "Q1") / nullif("Q1", 0) * 100', 4)} AS q4_over_q1_pct
FROM matrix""", _QUARTER, _MATRIX),
    "orders_by_weekday": query(f"""
SELECT dayname(order_date) AS day_of_week, count(*) AS orders,
       {money('sum(total_amount)')} AS revenue FROM done GROUP BY 1"""),
}
