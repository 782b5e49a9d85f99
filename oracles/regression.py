"""Comparison SQL for the regression: least squares by orthogonalising the inputs one by one."""

from __future__ import annotations

from oracles.base import half_up, query

_IN = ["orders", "aov", "avg_discount", "seg"]
_H = "((customer_id % 2147483647) * 48271 + 42) % 2147483647"


def _dot(a: str, b: str) -> str:
    return f"sum({a} * {b}) OVER ()"


_DATA = f"""data AS (
  SELECT *, ((({_H}) * ({_H})) % 2147483647 * 69621 + 42) % 2147483647 % 100 < 25 AS is_test
  FROM (SELECT customer_id, CAST(orders AS DOUBLE) AS orders, CAST(spent AS DOUBLE) AS revenue,
               CAST(spent AS DOUBLE) / orders AS aov, avg_discount,
               CAST(dense_rank() OVER (ORDER BY segment) - 1 AS DOUBLE) AS seg
        FROM buyer JOIN cust USING (customer_id)))"""

_MEANS = "means AS (SELECT avg(revenue) AS my, " + ", ".join(
    f"avg({x}) AS m{i}" for i, x in enumerate(_IN, 1)) + " FROM data WHERE NOT is_test)"

# x1..x4 and y centred; q1..q4 orthogonal; lij the part of input i that lies along qj.
_Q1 = "s1 AS (SELECT revenue - my AS y, orders - m1 AS q1, " + ", ".join(
    f"{x} - m{i} AS x{i}" for i, x in enumerate(_IN[1:], 2)) \
    + " FROM data, means WHERE NOT is_test)"
_L1 = "p1 AS (SELECT *, " + ", ".join(
    f"{_dot(f'x{i}', 'q1')} / {_dot('q1', 'q1')} AS l{i}1" for i in (2, 3, 4)) + " FROM s1)"
_Q2 = "s2 AS (SELECT *, x2 - l21 * q1 AS q2 FROM p1)"
_L2 = "p2 AS (SELECT *, " + ", ".join(
    f"{_dot(f'x{i}', 'q2')} / {_dot('q2', 'q2')} AS l{i}2" for i in (3, 4)) + " FROM s2)"
_Q3 = "s3 AS (SELECT *, x3 - l31 * q1 - l32 * q2 AS q3 FROM p2)"
_L3 = f"p3 AS (SELECT *, {_dot('x4', 'q3')} / {_dot('q3', 'q3')} AS l43 FROM s3)"
_Q4 = "s4 AS (SELECT *, x4 - l41 * q1 - l42 * q2 - l43 * q3 AS q4 FROM p3)"
_G = "g AS (SELECT " + ", ".join(
    f"sum(y * q{i}) / sum(q{i} * q{i}) AS g{i}" for i in (1, 2, 3, 4)) + ", " + ", ".join(
    f"any_value({x}) AS {x}" for x in ("l21", "l31", "l41", "l32", "l42", "l43")) + " FROM s4)"
_B = """b AS (
  SELECT *, g1 - l21 * b2 - l31 * b3 - l41 * b4 AS b1
  FROM (SELECT *, g2 - l32 * b3 - l42 * b4 AS b2
        FROM (SELECT *, g3 - l43 * b4 AS b3 FROM (SELECT *, g4 AS b4 FROM g))))"""
_FIT = """fit AS (
  SELECT b1, b2, b3, b4, my - b1 * m1 - b2 * m2 - b3 * m3 - b4 * m4 AS b0 FROM b, means)"""
_SCORE = """score AS (
  SELECT count(*) AS n, 1 - sum(pow(revenue - guess, 2)) / sum(pow(revenue - middle, 2)) AS r2,
         avg(abs(revenue - guess)) AS mae
  FROM (SELECT revenue, avg(revenue) OVER () AS middle,
               b0 + b1 * orders + b2 * aov + b3 * avg_discount + b4 * seg AS guess
        FROM data, fit WHERE is_test))"""


def _row(name: str, value: str, source: str) -> str:
    return f" SELECT '{name}' AS metric, {half_up(value, 4)} AS value FROM {source}"


REGRESSION = {"clv_regression": query("\nUNION ALL".join([
    _row("train_rows", "count(*)", "data WHERE NOT is_test"), _row("test_rows", "n", "score"),
    _row("r2", "r2", "score"), _row("mae", "mae", "score"), _row("intercept", "b0", "fit"),
    _row("coef_orders", "b1", "fit"), _row("coef_aov", "b2", "fit"),
    _row("coef_avg_discount", "b3", "fit"), _row("coef_segment_enc", "b4", "fit")]),
    _DATA, _MEANS, _Q1, _L1, _Q2, _L2, _Q3, _L3, _Q4, _G, _B, _FIT, _SCORE)}
