"""Comparison SQL for segmentation, cohorts, rankings, baskets, statistics and measures."""

from __future__ import annotations

from oracles.base import big, half_up, mean, money, percent, query, ratio, real
from oracles.sales import _CATEGORY, _RETURN_RATE, _STATE

DAY = "DATE '2002-01-01'"


def _label(score: str, names: list[str]) -> str:
    edges = [13, 10, 8, 6]
    cases = " ".join(f"WHEN {score} >= {e} THEN '{n}'" for e, n in zip(edges, names))
    return f"CASE {cases} ELSE {names[4] if names[4].startswith('CASE') else repr(names[4])} END"


_SIX = ["Champions", "Loyal Customers", "Potential Loyalists", "At Risk",
        "CASE WHEN r <= 2 THEN 'Lost Customers' ELSE 'Need Attention' END"]
_LONG = ["Champions", "Loyal Customers", "Potential Loyalists", "At Risk", "Lost Customers"]
_SHORT = ["Champions", "Loyal", "Potential Loyalists", "At Risk", "Lost"]


def _ntile(best_high: bool) -> str:
    flip = "6 - " if best_high else ""
    return f"""scored AS (
  SELECT *, r + f + m AS rfm_total FROM (
    SELECT *, {flip}ntile(5) OVER (ORDER BY recency_days, customer_id) AS r,
           {flip}ntile(5) OVER (ORDER BY orders DESC, customer_id) AS f,
           {flip}ntile(5) OVER (ORDER BY spent DESC, customer_id) AS m
    FROM (SELECT *, {DAY} - last_order_date AS recency_days FROM buyer)))"""


def _rfm_customers(best_high: bool) -> str:
    return query(f"""
SELECT customer_id, first_name || ' ' || last_name AS customer_name, segment, last_order_date,
       {big('recency_days')} AS recency_days, orders AS frequency, {money('spent')} AS monetary,
       CAST(r AS INTEGER) AS r_score, CAST(f AS INTEGER) AS f_score, CAST(m AS INTEGER) AS m_score,
       CAST(rfm_total AS INTEGER) AS rfm_total, concat(r, f, m) AS rfm_cell,
       {_label('rfm_total', _SIX)} AS rfm_segment
FROM scored JOIN cust USING (customer_id)""", _ntile(best_high))


def _rfm_segments(best_high: bool) -> str:
    return query(f"""
SELECT {_label('rfm_total', _SIX)} AS rfm_segment, count(*) AS customers,
       {mean('recency_days', 0)} AS avg_recency, {mean('orders', 1)} AS avg_frequency,
       {mean('spent')} AS avg_monetary, {money('sum(spent)')} AS total_revenue
FROM scored GROUP BY 1""", _ntile(best_high))


def _past(column: str, edges: str) -> str:
    return " + ".join(f"CAST({column} > {edges}[{i}] AS INTEGER)" for i in (1, 2, 3, 4))


_QCUT = f"""base AS (
  SELECT customer_id, {big(f'{DAY} - last_order_date')} AS recency, orders AS frequency, spent,
         {real('spent')} AS x, row_number() OVER (ORDER BY orders, customer_id) AS place
  FROM buyer),
edge AS (
  SELECT quantile_cont(recency, [0.2, 0.4, 0.6, 0.8]) AS re,
         quantile_cont(x, [0.2, 0.4, 0.6, 0.8]) AS me, count(*) AS n FROM base),
qcut AS (
  SELECT customer_id, recency, frequency, spent,
         CAST(5 - ({_past('recency', 're')}) AS INTEGER) AS r,
         CAST(1 + CAST(place > 1 + (n - 1) // 5 AS INTEGER)
                + CAST(place > 1 + (n - 1) * 2 // 5 AS INTEGER)
                + CAST(place > 1 + (n - 1) * 3 // 5 AS INTEGER)
                + CAST(place > 1 + (n - 1) * 4 // 5 AS INTEGER) AS INTEGER) AS f,
         CAST(1 + {_past('x', 'me')} AS INTEGER) AS m
  FROM base, edge),
rfm AS (
  SELECT *, r + f + m AS rfm_score, {_label('r + f + m', _SHORT)} AS short_label,
         {_label('r + f + m', _LONG)} AS long_label FROM qcut)"""

RFM = {
    "rfm_customers_as_written": _rfm_customers(False),
    "rfm_customers_best_high": _rfm_customers(True),
    "rfm_segments_as_written": _rfm_segments(False),
    "rfm_segments_best_high": _rfm_segments(True),
    "rfm_quantile": query(f"""
SELECT customer_id, recency, frequency, {money('spent')} AS monetary, r, f, m, rfm_score,
       short_label AS segment FROM rfm""", _QCUT),
    "rfm_segment_summary": query(f"""
SELECT short_label AS segment, count(*) AS customers,
       {percent('count(*)', 'sum(count(*)) OVER ()', 1)} AS customers_pct,
       {mean('spent')} AS avg_monetary FROM rfm GROUP BY 1""", _QCUT),
    "rfm_report": query(f"""
SELECT customer_id, concat(first_name, ' ', last_name) AS name, segment, city, recency, frequency,
       {money('spent')} AS monetary, rfm_score, long_label AS rfm_segment
FROM rfm JOIN cust USING (customer_id)""", _QCUT),
    "rfm_segment_pivot": query(f"""
SELECT long_label AS rfm_segment, count(*) AS customers, {mean('spent')} AS avg_clv,
       {half_up('avg(recency)', 1)} AS avg_recency FROM rfm GROUP BY 1""", _QCUT),
    "customer_kpis": query("""
SELECT (SELECT count(*) FROM cust) AS total_customers,
       count(*) FILTER (short_label = 'Champions') AS champions,
       count(*) FILTER (short_label IN ('At Risk', 'Lost')) AS churn_risk FROM rfm""", _QCUT),
    "rfm_scatter": query(f"""
SELECT customer_id, frequency, {money('spent')} AS monetary, short_label AS rfm_segment
FROM rfm""", _QCUT),
    "pareto_share": query(f"""
SELECT count(*) AS customers, count(*) FILTER (b = 1) AS top_customers,
       {money('sum(spent) FILTER (b = 1)')} AS top_revenue, {money('sum(spent)')} AS revenue,
       {percent('sum(spent) FILTER (b = 1)', 'sum(spent)', 4)} AS top_share_pct
FROM (SELECT spent, ntile(5) OVER (ORDER BY spent DESC, customer_id) AS b FROM buyer)"""),
}

_COHORT = """act AS (
  SELECT customer_id, strftime(order_date, '%Y-%m') AS order_month,
         min(strftime(order_date, '%Y-%m')) OVER (PARTITION BY customer_id) AS cohort_month
  FROM done)"""
_CELLS = f"""
SELECT a.cohort_month, s.n AS cohort_customers, a.order_month,
       count(DISTINCT a.customer_id) AS active_customers,
       {percent('count(DISTINCT a.customer_id)', 's.n', 1)} AS retention_pct
FROM act a JOIN (SELECT cohort_month, count(DISTINCT customer_id) AS n FROM act GROUP BY 1) s
     USING (cohort_month)
GROUP BY a.cohort_month, s.n, a.order_month"""
_PAIRS = """
SELECT pa.category AS cat_a, pb.category AS cat_b, count(*) AS co_occurrence
FROM line la JOIN line lb ON la.order_id = lb.order_id AND la.item_id < lb.item_id
     JOIN prod pa ON pa.product_id = la.product_id JOIN prod pb ON pb.product_id = lb.product_id
GROUP BY 1, 2"""
_FULFILLED = """ful AS (
  SELECT o.order_id, l.product_id, p.category, p.product_name, r.return_id
  FROM ord o JOIN line l USING (order_id) JOIN prod p ON p.product_id = l.product_id
       LEFT JOIN ret r ON r.order_id = o.order_id WHERE o.status IN ('Delivered', 'Returned'))"""
_MARGIN_TABLE = f"""
SELECT product_id, product_name, category, {big('sum(quantity)')} AS units_sold,
       {money('sum(line_revenue)')} AS revenue,
       {money('sum(line_revenue) - sum(quantity * cost_price)')} AS profit,
       {ratio('sum(line_revenue) - sum(quantity * cost_price)', 'sum(line_revenue)', 6)} AS margin
FROM sold"""

RANKINGS = {
    "cohort_retention": query(_CELLS + " ORDER BY cohort_month, order_month LIMIT 50", _COHORT),
    "cohort_retention_full": query(_CELLS, _COHORT),
    "new_vs_repeat": query(f"""
SELECT CASE WHEN k = 1 THEN 'New Customer' ELSE 'Repeat Customer' END AS customer_type,
       count(*) AS orders, {money('sum(total_amount)')} AS revenue, {mean('total_amount')} AS aov
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS k
      FROM done) GROUP BY 1"""),
    "top_products_revenue": query(f"""
SELECT product_id, product_name, category, brand, {big('sum(quantity)')} AS units_sold,
       {money('sum(line_revenue)')} AS revenue, {half_up('avg(unit_price)', 2)} AS avg_price
FROM sold GROUP BY ALL ORDER BY revenue DESC, product_id LIMIT 10"""),
    "top_states": query(f"""
SELECT state, customers, orders, {money('spent')} AS revenue, {ratio('spent', 'orders', 2)} AS aov
FROM st ORDER BY revenue DESC, state LIMIT 5""", _STATE),
    "top_customers": query(f"""
SELECT customer_id, first_name || ' ' || last_name AS name, segment, city, orders AS total_orders,
       {money('spent')} AS lifetime_value, {ratio('spent', 'orders', 2)} AS avg_order_value,
       last_order_date
FROM buyer JOIN cust USING (customer_id) ORDER BY lifetime_value DESC, customer_id LIMIT 10"""),
    "product_return_rate": query(f"""
SELECT product_id, product_name, category, count(DISTINCT order_id) AS total_orders,
       count(DISTINCT return_id) AS returns,
       {percent('count(DISTINCT return_id)', 'count(DISTINCT order_id)', 1)} AS return_rate_pct
FROM ful GROUP BY ALL HAVING count(DISTINCT order_id) >= 5
ORDER BY return_rate_pct DESC, product_id LIMIT 10""", _FULFILLED),
    "category_return_rate": query(f"""
SELECT category, count(DISTINCT order_id) AS total_orders, count(DISTINCT return_id) AS returns,
       {percent('count(DISTINCT return_id)', 'count(DISTINCT order_id)', 1)} AS return_rate_pct
FROM ful GROUP BY category""", _FULFILLED),
    "customers_by_state": query("SELECT state, count(*) AS customers FROM cust GROUP BY state"),
    "product_kpis": query(f"""
SELECT (SELECT count(*) FROM prod) AS total_products,
       (SELECT return_rate_pct FROM rate) AS return_rate_pct, category AS best_margin_category,
       {percent('profit', 'revenue', 4)} AS margin_pct
FROM cat ORDER BY margin_pct DESC, category LIMIT 1""", _CATEGORY, _RETURN_RATE),
    "product_margin_table": query(_MARGIN_TABLE + " GROUP BY ALL"),
    "product_margin_drill": query(_MARGIN_TABLE + " WHERE category = 'PROMO' GROUP BY ALL"),
    "return_reasons": query("SELECT reason, count(*) AS returns FROM ret GROUP BY reason"),
    "category_margin_rank": query(f"""
SELECT category, revenue, margin, rank() OVER (ORDER BY revenue DESC) AS revenue_rank,
       rank() OVER (ORDER BY margin DESC) AS margin_rank
FROM (SELECT category, {money('revenue')} AS revenue, {ratio('profit', 'revenue', 6)} AS margin
      FROM cat)""", _CATEGORY),
    "channel_mix": query(f"""
SELECT channel, count(*) AS orders, {money('sum(total_amount)')} AS revenue,
       {mean('total_amount')} AS aov,
       {ratio('count(*)', 'sum(count(*)) OVER ()', 6)} AS order_share
FROM done GROUP BY channel"""),
    "state_concentration": query(f"""
SELECT state, {money('spent')} AS revenue, row_number() OVER w AS states,
       {ratio('sum(spent) OVER w', 'sum(spent) OVER ()', 6)} AS cumulative_share
FROM st WINDOW w AS (ORDER BY spent DESC, state ROWS UNBOUNDED PRECEDING)""", _STATE),
    "category_basket_pairs": query(
        _PAIRS + " ORDER BY co_occurrence DESC, cat_a, cat_b LIMIT 10"),
    "category_basket_pairs_all": query(_PAIRS),
}

# -- statistics --------------------------------------------------------------------------------

_V = f"v AS (SELECT {real('total_amount')} AS x FROM done)"
_SPAN = """span AS (
  SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 40 AS w, count(*) AS total,
         stddev_samp(x) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h FROM v),
bars AS (
  SELECT b AS bin, count(v.x) AS n FROM range(40) t(b), span
  LEFT JOIN v ON least(floor((v.x - span.lo) / span.w), 39) = b GROUP BY b)"""
_FEATURES = f"""feat AS (
  SELECT customer_id, orders, {real('spent')} AS revenue, {real('spent')} / orders AS aov,
         avg_discount, segment FROM buyer JOIN cust USING (customer_id))"""


def _beta_tail(t: str, free: str) -> str:
    """Two-sided t p-value as a scalar subquery: Lentz steps in a recursive CTE.

    Uses I_x(a, b) with x = free / (free + t^2), a = free / 2, b = 1/2, turned round where the
    fraction converges faster that way.
    """
    return f"""(
  WITH RECURSIVE z AS (SELECT {real(t)} AS t, {real(free)} AS v),
  raw AS (SELECT v / (v + t * t) AS x0, v / 2 AS a0, CAST(0.5 AS DOUBLE) AS b0 FROM z),
  arg AS (SELECT x0 > (a0 + 1) / (a0 + b0 + 2) AS flip,
                 CASE WHEN x0 > (a0 + 1) / (a0 + b0 + 2) THEN 1 - x0 ELSE x0 END AS x,
                 CASE WHEN x0 > (a0 + 1) / (a0 + b0 + 2) THEN b0 ELSE a0 END AS a,
                 CASE WHEN x0 > (a0 + 1) / (a0 + b0 + 2) THEN a0 ELSE b0 END AS b FROM raw),
  step AS (
    SELECT 1 AS k, CAST(1 AS DOUBLE) AS c, 1 / (1 - (a + b) * x / (a + 1)) AS d,
           1 / (1 - (a + b) * x / (a + 1)) AS f, x, a, b, flip FROM arg
    UNION ALL
    SELECT k + 1, 1 + q / c, 1 / (1 + q * d), f * (1 + q / c) / (1 + q * d), x, a, b, flip
    FROM (SELECT *, CASE WHEN k % 2 = 1
                         THEN (k + 1) / 2.0 * (b - (k + 1) / 2.0) * x / ((a + k) * (a + k + 1))
                         ELSE -(a + k / 2.0) * (a + b + k / 2.0) * x / ((a + k) * (a + k + 1))
                    END AS q FROM step) WHERE k < 400)
  SELECT CASE WHEN flip THEN 1 - p ELSE p END FROM (
    SELECT flip, f * exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(x) + b * ln(1 - x)) / a AS p
    FROM step WHERE k = 400))"""


_TWO = f"""two AS (
  SELECT count(*) FILTER (side = 'a') AS n_a, avg(x) FILTER (side = 'a') AS mean_a,
         var_samp(x) FILTER (side = 'a') AS var_a, count(*) FILTER (side = 'b') AS n_b,
         avg(x) FILTER (side = 'b') AS mean_b, var_samp(x) FILTER (side = 'b') AS var_b
  FROM sides),
tested AS (
  SELECT *, (mean_a - mean_b) / sqrt(((n_a - 1) * var_a + (n_b - 1) * var_b) / (n_a + n_b - 2)
                                     * (1.0 / n_a + 1.0 / n_b)) AS t FROM two),
judged AS (SELECT *, {_beta_tail('(SELECT t FROM tested)',
                                 '(SELECT n_a + n_b - 2 FROM tested)')} AS p FROM tested)"""
_TWO_OUT = f"""
SELECT n_a, n_b, {half_up('mean_a', 2)} AS mean_a, {half_up('mean_b', 2)} AS mean_b,
       {half_up('t', 6)} AS t_stat, {half_up('p', 6)} AS p_value,
       CASE WHEN p < 0.05 THEN 'Significant' ELSE 'Not significant' END AS verdict FROM judged"""


def _sides(select: str) -> str:
    return f"sides AS ({select})"


_PAIRS_OF = [("revenue", "orders"), ("aov", "orders"), ("avg_discount", "orders"),
             ("aov", "revenue"), ("avg_discount", "revenue"), ("avg_discount", "aov")]
_FIT = """fit AS (SELECT regr_slope(revenue, orders) AS slope,
  regr_intercept(revenue, orders) AS intercept, regr_r2(revenue, orders) AS r2,
  min(orders) AS lo, max(orders) AS hi FROM feat)"""

STATS = {
    "order_value_describe": query(f"""
SELECT count(x) AS "count", {half_up('avg(x)', 2)} AS mean, {half_up('stddev_samp(x)', 2)} AS std,
       min(x) AS min, max(x) AS max, {half_up('quantile_cont(x, 0.25)', 2)} AS p25,
       {half_up('quantile_cont(x, 0.5)', 2)} AS p50, {half_up('quantile_cont(x, 0.75)', 2)} AS p75
FROM v""", _V),
    "order_value_histogram": query(f"""
SELECT {big('bin')} AS bin, {half_up('lo + bin * w', 4)} AS lower,
       {half_up('lo + bin * w + w', 4)} AS upper, n AS orders,
       (SELECT {half_up('avg(x)', 2)} FROM v) AS mean,
       (SELECT {half_up('median(x)', 2)} FROM v) AS median
FROM bars, span""", _V, _SPAN),
    "order_value_density": query(f"""
SELECT {big('g')} AS point, {half_up('x', 4)} AS x,
       {half_up('sum(n * exp(-0.5 * pow((x - c) / h, 2))) / (any_value(total) * any_value(h) * sqrt(2 * pi()))', 10)}
         AS density
FROM (SELECT g, lo + (hi - lo) * g / 199 AS x, lo + (bin + 0.5) * w AS c, n, h, total
      FROM range(200) t(g), span, bars)
GROUP BY g, x""", _V, _SPAN),
    "order_value_box_by_segment": query(f"""
SELECT segment, count(*) AS orders, {half_up('q[1]', 2)} AS q1, {half_up('q[2]', 2)} AS median,
       {half_up('q[3]', 2)} AS q3, min(x) FILTER (ok) AS whisker_low,
       max(x) FILTER (ok) AS whisker_high,
       {half_up('q[2] - 1.57 * (q[3] - q[1]) / sqrt(count(*))', 2)} AS notch_low,
       {half_up('q[2] + 1.57 * (q[3] - q[1]) / sqrt(count(*))', 2)} AS notch_high,
       count(*) FILTER (NOT ok) AS outliers
FROM (SELECT segment, x, q,
             x BETWEEN q[1] - 1.5 * (q[3] - q[1]) AND q[3] + 1.5 * (q[3] - q[1]) AS ok
      FROM sx JOIN (SELECT segment, quantile_cont(x, [0.25, 0.5, 0.75]) AS q FROM sx GROUP BY 1)
           USING (segment))
GROUP BY segment, q""", f"""sx AS (SELECT segment, {real('total_amount')} AS x
  FROM done JOIN cust USING (customer_id))"""),
    "customer_features": query(f"""
SELECT customer_id, orders, revenue, {half_up('aov', 4)} AS aov,
       {half_up('avg_discount', 6)} AS avg_discount, segment FROM feat""", _FEATURES),
    "customer_correlations": query("\nUNION ALL ".join(
        f" SELECT '{a}' AS row_feature, '{b}' AS column_feature, "
        f"{half_up(f'corr({a}, {b})', 6)} AS correlation FROM feat" for a, b in _PAIRS_OF),
        _FEATURES),
    "orders_revenue_trend": query(f"""
SELECT {half_up('slope', 2)} AS slope, {half_up('intercept', 2)} AS intercept,
       {half_up('r2', 6)} AS r2 FROM fit""", _FEATURES, _FIT),
    "orders_revenue_trend_line": query(f"""
SELECT {big('k')} AS point, {half_up('x', 6)} AS orders,
       {half_up('slope * x + intercept', 2)} AS revenue
FROM (SELECT k, slope, intercept, lo + {real('hi - lo')} * k / 49 AS x FROM range(50) t(k), fit)""",
        _FEATURES, _FIT),
    "normality_check": query(f"""
SELECT n, {half_up('jb', 3)} AS statistic, {half_up('exp(-jb / 2)', 6)} AS p_value,
       CASE WHEN exp(-jb / 2) < 0.05 THEN 'Not normal' ELSE 'Normal' END AS verdict
FROM (SELECT n, n / 6.0 * (pow(m3 / pow(m2, 1.5), 2) + pow(m4 / (m2 * m2) - 3, 2) / 4) AS jb
      FROM (SELECT count(*) AS n, avg(pow(x - mu, 2)) AS m2, avg(pow(x - mu, 3)) AS m3,
                   avg(pow(x - mu, 4)) AS m4 FROM v, (SELECT avg(x) AS mu FROM v)))""", _V),
    "segment_ttest": query(_TWO_OUT, _sides(f"""
  SELECT {real('total_amount')} AS x, CASE segment WHEN 'BUILDING' THEN 'a' ELSE 'b' END AS side
  FROM done JOIN cust USING (customer_id) WHERE segment IN ('BUILDING', 'MACHINERY')"""), _TWO),
    "discount_ttest": query(_TWO_OUT, _sides(f"""
  SELECT {real('total_amount')} AS x, CASE WHEN discount_pct = 0 THEN 'a' ELSE 'b' END AS side
  FROM done"""), _TWO),
    "pearson_test": query(f"""
SELECT n, {half_up('r', 6)} AS r, {half_up('p', 6)} AS p_value
FROM (SELECT n, r, {_beta_tail('(SELECT r * sqrt((n - 2) / (1 - r * r)) FROM rr)',
                               '(SELECT n - 2 FROM rr)')} AS p FROM rr)""", _FEATURES,
        "rr AS (SELECT count(*) AS n, corr(orders, revenue) AS r FROM feat)"),
}

# -- measures ----------------------------------------------------------------------------------

_D = "status = 'Delivered'"
_SLICED = f"""picked AS (
  SELECT ord.*, c.segment FROM ord JOIN cust c USING (customer_id)
  WHERE year(order_date) IN (1997, 1998) AND c.segment IN ('BUILDING', 'MACHINERY')
    AND ord.channel = 'Mobile App'
    AND order_id IN (SELECT order_id FROM line JOIN prod USING (product_id)
                     WHERE category IN ('PROMO', 'SMALL')))"""

# The same tables within a range of dates, some states and some statuses.
_DATED = """dated AS (
  SELECT ord.*, c.segment FROM ord JOIN cust c USING (customer_id)
  WHERE order_date BETWEEN DATE '1996-03-15' AND DATE '1998-02-01'
    AND ord.state IN ('NATION_1', 'NATION_2', 'NATION_5', 'NATION_8', 'NATION_13') AND status IN ('Delivered', 'Returned'))"""
_WITH_SEGMENT = "whole AS (SELECT ord.*, c.segment FROM ord JOIN cust c USING (customer_id))"
_SLICED_BY = "year, segment, state, status, channel"


def _cube(source: str) -> str:
    return f"""
SELECT {big(f'grouping_id({_SLICED_BY})')} AS open, CAST(year AS INTEGER) AS year, segment, state, status, channel,
       count(*) AS orders, {money(f"sum(total_amount) FILTER ({_D})")} AS revenue,
       count(DISTINCT customer_id) AS customers,
       count(DISTINCT customer_id) FILTER ({_D}) AS active_customers
FROM (SELECT *, year(order_date) AS year FROM {source}) GROUP BY CUBE ({_SLICED_BY})"""


MEASURES = {
    "total_revenue": query(f" SELECT {money('sum(total_amount)')} AS total_revenue FROM done"),
    "total_revenue_by_segment": query(f"""
SELECT segment, {money('sum(total_amount)')} AS total_revenue
FROM done JOIN cust USING (customer_id) GROUP BY segment"""),
    "aov": query(f" SELECT {mean('total_amount')} AS aov FROM done"),
    "clv": query(f"""
SELECT {ratio(f"sum(total_amount) FILTER ({_D})", 'count(DISTINCT customer_id)', 2)} AS clv
FROM ord"""),
    "clv_by_state": query(f"""
SELECT state, coalesce({ratio(f"sum(total_amount) FILTER ({_D})", 'count(DISTINCT customer_id)', 2)},
                       0) AS clv FROM ord GROUP BY state"""),
    "return_rate_status": query(f"""
SELECT {ratio("count(*) FILTER (status = 'Returned')",
              "count(*) FILTER (status IN ('Returned', 'Delivered'))", 6)} AS return_rate
FROM ord"""),
    "sliced_cards": query(f"""
SELECT {money(f"sum(total_amount) FILTER ({_D})")} AS total_revenue,
       count(*) FILTER ({_D}) AS orders,
       {ratio(f"sum(total_amount) FILTER ({_D})", f"count(*) FILTER ({_D})", 2)} AS aov,
       count(DISTINCT customer_id) FILTER ({_D}) AS active_customers,
       {percent("count(*) FILTER (status = 'Cancelled')", 'count(*)', 4)} AS cancel_pct
FROM picked""", _SLICED),
    "sliced_revenue_by_month": query(f"""
SELECT strftime(order_date, '%Y-%m') AS year_month, {money('sum(total_amount)')} AS revenue
FROM picked WHERE {_D} GROUP BY 1""", _SLICED),
    "sliced_category_revenue": query(f"""
SELECT category, {money('sum(line_revenue)')} AS revenue,
       {ratio('sum(line_revenue)', 'sum(sum(line_revenue)) OVER ()', 6)} AS revenue_share
FROM sold WHERE order_id IN (SELECT order_id FROM picked) AND category IN ('PROMO', 'SMALL')
GROUP BY category""", _SLICED),
    "sliced_dates_status": query(f"""
SELECT status, count(*) AS order_count, {percent('count(*)', 'sum(count(*)) OVER ()', 1)} AS pct
FROM dated GROUP BY status""", _DATED),
    "sliced_dates_cards": query(f"""
SELECT {money(f"sum(total_amount) FILTER ({_D})")} AS total_revenue,
       count(*) FILTER ({_D}) AS orders,
       {ratio(f"sum(total_amount) FILTER ({_D})", f"count(*) FILTER ({_D})", 2)} AS aov,
       count(DISTINCT customer_id) FILTER ({_D}) AS active_customers,
       {percent("count(*) FILTER (status = 'Cancelled')", 'count(*)', 4)} AS cancel_pct
FROM dated""", _DATED),
    "slicer_cube": query(_cube("whole"), _WITH_SEGMENT),
    "slicer_cube_dates": query(_cube("dated"), _DATED),
    "category_revenue_share": query(f"""
SELECT category, {money('revenue')} AS revenue,
       {ratio('revenue', 'sum(revenue) OVER ()', 6)} AS revenue_share FROM cat""", _CATEGORY),
    "revenue_by_month": query(f"""
SELECT strftime(order_date, '%Y-%m') AS year_month, {money('sum(total_amount)')} AS revenue
FROM done GROUP BY 1"""),
}


def _dictionary() -> str:
    from tradelens.sources.bound import COLUMNS
    from tradelens.sources.schema import SCHEMAS
    source = {"customers": "cust", "products": "prod", "orders": "ord", "order_items": "line",
              "returns": "ret"}
    rows = []
    for table, columns in COLUMNS.items():
        fields = {f.name: f for f in SCHEMAS[table]}
        for c in columns:
            text = fields[c].metadata["comment"].replace("'", "''")
            rows.append(
                f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", "
                f"'{fields[c].dataType.simpleString()}' AS \"type\", '{text}' AS description, "
                f"CAST(min({c}) AS VARCHAR) AS example FROM {source[table]}")
    return query("\n" + "\nUNION ALL ".join(rows))


REPORT = {"data_dictionary": _dictionary()}
