"""Hand-made canonical tables; columns left out are filled with harmless values."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import SparkSession
from pyspark.sql.types import DecimalType

from tradelens.sources.schema import SCHEMAS
from tradelens.sources.tables import Tables

DEFAULTS = {
    "customers": {"first_name": "Ann", "last_name": "Lee", "email": "a@x", "segment": "Premium",
                  "state": "Kerala", "city": "Kochi", "registration_date": date(2020, 1, 1)},
    "products": {"product_name": "Lamp", "category": "Home", "brand": "B", "unit_price": 10.0,
                 "cost_price": Decimal("4.00")},
    "orders": {"customer_id": 1, "order_date": date(2024, 1, 1), "status": "Delivered",
               "payment_mode": "UPI", "channel": "Website", "discount_pct": 0.0,
               "total_amount": Decimal("10.00"), "state": "Kerala", "city": "Kochi"},
    "order_items": {"product_id": 1, "quantity": 1, "unit_price": 10.0, "discount_pct": 0.0,
                    "line_revenue": Decimal("10.0000")},
    "returns": {"return_date": date(2024, 1, 5), "reason": "Changed mind", "status": "Approved"},
}


def _typed(value, kind):
    return Decimal(value) if isinstance(kind, DecimalType) and isinstance(value, int) else value


def make(spark: SparkSession, **tables: list[dict]) -> Tables:
    frames = {}
    for name, schema in SCHEMAS.items():
        rows = [{**DEFAULTS[name], **row} for row in tables.get(name, [])]
        values = [tuple(_typed(row.get(f.name), f.dataType) for f in schema) for row in rows]
        frames[name] = spark.createDataFrame(values, schema)
    return Tables(frames)


def orders(*amounts, **common) -> list[dict]:
    return [{"order_id": i, "total_amount": None if a is None else Decimal(str(a)), **common}
            for i, a in enumerate(amounts, 1)]
