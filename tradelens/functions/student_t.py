"""Two-sided Student-t p-value, for the one-row results of the significance tests."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def t_two_sided(t: Column, freedom: Column) -> Column:
    """P(|T| >= |t|); NULL in, NULL out.

    The helpers live inside the function so that the workers need no package on their path.
    """

    @F.pandas_udf("double")
    def p_value(t_values: pd.Series, freedoms: pd.Series) -> pd.Series:
        import math

        def half_step(a: float) -> float:
            """log gamma(a + 1/2) - log gamma(a), without the difference of two large numbers."""
            if a < 100:
                return math.lgamma(a + 0.5) - math.lgamma(a)
            return 0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3) - 1 / (640 * a**5)

        def fraction(x: float, a: float, b: float) -> float:
            """Lentz evaluation of the continued fraction of the incomplete beta function."""
            tiny = 1e-300
            c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
            d = 1.0 / (d if abs(d) > tiny else tiny)
            value = d
            for m in range(1, 1_000_000):
                even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
                odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
                for term in (even, odd):
                    d = 1.0 + term * d
                    d = 1.0 / (d if abs(d) > tiny else tiny)
                    c = 1.0 + term / c
                    c = c if abs(c) > tiny else tiny
                    value *= c * d
                if abs(c * d - 1.0) < 1e-14:
                    return value
            raise ArithmeticError(f"no convergence for x={x}, a={a}, b={b}")

        def one(t_value: float, free: float) -> float | None:
            """The incomplete beta function of free / (free + t^2) at (free / 2, 1 / 2)."""
            if pd.isna(t_value) or pd.isna(free) or free <= 0:
                return None
            square = t_value * t_value
            if square == 0.0:
                return 1.0
            if math.isinf(square):
                return 0.0
            a, rest = free / 2.0, square / (free + square)
            log_front = (-a * math.log1p(square / free) + 0.5 * math.log(rest)
                         + half_step(a) - 0.5 * math.log(math.pi))
            if 1.0 - rest > (a + 1.0) / (a + 2.5):
                return 1.0 - math.exp(log_front) * fraction(rest, 0.5, a) / 0.5
            return math.exp(log_front) * fraction(1.0 - rest, a, 0.5) / a

        return pd.Series([one(a, b) for a, b in zip(t_values, freedoms)], dtype="float64")

    return p_value(t, freedom)
