"""Numbers as text, for the edge of a report only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradelens.functions.numeric import real

# --- fixed value ---
CURRENCY = "₹"


def thousands(value: Column | str) -> Column:
    return F.format_number(value, 0)


def currency(value: Column | str) -> Column:
    return F.concat(F.lit(CURRENCY), thousands(value))


def percent_text(value: Column | str) -> Column:
    """A percentage with one digit."""
    return F.concat(F.format_number(real(value), 1), F.lit("%"))
