"""Key checks, null counts and reproducible row samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.functions.numeric import scatter


def duplicate_keys(df: DataFrame, keys: list[str], count_name: str = "cnt") -> DataFrame:
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
            .where(F.col(count_name) > 1))


def orphans(child: DataFrame, parent: DataFrame, child_key: str,
            parent_key: str | None = None, parent_is_unique: bool = True) -> DataFrame:
    """Child rows whose key no parent row has.

    A parent in which a key may repeat is reduced to its keys first, on the map side as well, so
    a hot key does not travel.
    """
    keys = parent.select(F.col(parent_key or child_key).alias(child_key))
    return child.join(keys if parent_is_unique else keys.distinct(), child_key, "left_anti")


def sample_rows(df: DataFrame, rows: int, key: str, seed: int) -> DataFrame:
    """Exactly ``rows`` rows (all if fewer), the same ones on every run, as a top-k."""
    return df.orderBy(scatter(key, seed), key).limit(rows)

