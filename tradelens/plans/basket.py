"""Categories bought together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.operators.pairs import ordered_label_pairs
from tradelens.sources.tables import LINE_SEQ, Tables


def category_basket_pairs(tables: Tables, limit: int | None = 10) -> DataFrame:
    """Line pairs of one order by category, earlier line first; same-category pairs included."""
    lines = tables.order_items("order_id", "product_id", LINE_SEQ).join(
        tables.products("product_id", "category"), "product_id")
    pairs = ordered_label_pairs(lines, "order_id", LINE_SEQ, "category").select(
        F.col("a").alias("cat_a"), F.col("b").alias("cat_b"), F.col("n").alias("co_occurrence"),
    ).orderBy(F.desc("co_occurrence"), "cat_a", "cat_b")
    return pairs if limit is None else pairs.limit(limit)
