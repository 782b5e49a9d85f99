"""Value-to-label rules and calendar labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: lowest total score of each customer group, best group first ---
SHORT_LABELS = [(13, "Champions"), (10, "Loyal"), (8, "Potential Loyalists"),
                (6, "At Risk"), (None, "Lost")]
LONG_LABELS = [(13, "Champions"), (10, "Loyal Customers"), (8, "Potential Loyalists"),
               (6, "At Risk"), (None, "Lost Customers")]
# Upper edge of each discount band, edge included.
DISCOUNT_BANDS = [(0.0, "No Discount"), (0.1, "Up to 10%"), (0.2, "11-20%")]
ABOVE_BANDS = "Above 20%"


def score_label(score: Column, labels=SHORT_LABELS) -> Column:
    chain = F
    for least, name in labels:
        chain = chain.otherwise(name) if least is None else chain.when(score >= least, F.lit(name))
    return chain


def score_label_six(score: Column, recency_score: Column) -> Column:
    """The six-way wording, which splits the lowest group by recency."""
    low = F.when(recency_score <= 2, "Lost Customers").otherwise("Need Attention")
    return score_label(score, [*LONG_LABELS[:-1], (None, low)])


def discount_band(discount: Column) -> Column:
    """Missing discounts fall into the last band."""
    chain = F.when(discount == DISCOUNT_BANDS[0][0], DISCOUNT_BANDS[0][1])
    for edge, name in DISCOUNT_BANDS[1:]:
        chain = chain.when(discount <= edge, name)
    return chain.otherwise(ABOVE_BANDS)


def year_month(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM")


def weekday_name(day: Column | str) -> Column:
    return F.date_format(day, "EEEE")
