"""Rounding and guarded ratios.

Money is summed and rounded as DECIMAL and turned into a double last. Averages and ratios are
doubles; they are rounded half away from zero with plain arithmetic, so that the same number
comes out whichever engine does it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def real(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


_NO_FRACTION = float(1 << 52)  # doubles from here on have no digits to round


def half_up(value: Column, digits: int) -> Column:
    scale = float(10 ** digits)
    value = real(value)
    rounded = F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / F.lit(scale)
    return F.when(F.abs(value) * scale < _NO_FRACTION, rounded).otherwise(value)


def money(value: Column | str, digits: int = 2) -> Column:
    """Round a DECIMAL amount and hand it over as a double."""
    return real(F.round(value, digits))


def total(value: Column | str, digits: int = 2) -> Column:
    return money(F.sum(value), digits)


def mean(value: Column | str, digits: int = 2) -> Column:
    """Average of a DECIMAL column from its exact sum."""
    return half_up(F.try_divide(real(F.sum(value)), F.count(value)), digits)


def ratio(top: Column | str, bottom: Column | str, digits: int | None = None,
          scale: float = 1.0) -> Column:
    """``scale * top / bottom``; NULL when the bottom is zero or missing."""
    value = F.try_divide(F.lit(scale) * real(top), real(bottom))
    return value if digits is None else half_up(value, digits)


def percent(top: Column | str, bottom: Column | str, digits: int = 1) -> Column:
    return ratio(top, bottom, digits, 100.0)


# --- fixed values: multiplicative generator modulo the Mersenne prime 2^31 - 1 ---
_PRIME, _STEP_A, _STEP_B = 2147483647, 48271, 69621


def scatter(key: Column | str, seed: int) -> Column:
    """A reproducible pseudo-random integer in [0, 2^31 - 1) for an integer key.

    Depends on the key and the seed only, never on partitioning or row order.
    """
    key = F.col(key) if isinstance(key, str) else key
    first = F.pmod(F.pmod(key, F.lit(_PRIME)).cast("bigint") * _STEP_A + seed, F.lit(_PRIME))
    squared = F.pmod(first * first, F.lit(_PRIME))
    return F.pmod(squared * _STEP_B + seed, F.lit(_PRIME))
