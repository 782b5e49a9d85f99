"""The five canonical tables: types, keys, domains and column descriptions."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------------------------
SEGMENTS = ["Premium", "Regular", "Budget"]
ORDER_STATUSES = ["Delivered", "Shipped", "Cancelled", "Returned", "Processing"]
RETURN_STATUSES = ["Approved", "Pending", "Rejected"]
RETURN_REASONS = [
    "Defective product", "Wrong item delivered", "Changed mind",
    "Better price elsewhere", "Not as described", "Damaged packaging",
]
CHANNELS = ["Mobile App", "Website", "Mobile Web"]
# ------------------------------------------------------------------------------------------


def _table(*columns: tuple[str, T.DataType, bool, str]) -> T.StructType:
    return T.StructType(
        [T.StructField(name, kind, nullable, {"comment": text})
         for name, kind, nullable, text in columns]
    )


_LONG, _INT, _TEXT, _DATE, _REAL = (
    T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.DoubleType())

SCHEMAS: dict[str, T.StructType] = {
    "customers": _table(
        ("customer_id", _LONG, False, "Customer key"),
        ("first_name", _TEXT, False, "Given name"),
        ("last_name", _TEXT, False, "Family name"),
        ("email", _TEXT, False, "Contact address, one per customer"),
        ("phone", _TEXT, True, "Contact number"),
        ("city", _TEXT, True, "Home city"),
        ("state", _TEXT, True, "Home state"),
        ("pincode", _TEXT, True, "Postal code"),
        ("segment", _TEXT, True, "Customer tier"),
        ("registration_date", _DATE, False, "Day the account was opened"),
        ("is_active", _INT, True, "1 while the account is in use"),
    ),
    "products": _table(
        ("product_id", _LONG, False, "Product key"),
        ("product_name", _TEXT, False, "Display name"),
        ("category", _TEXT, False, "Product category"),
        ("brand", _TEXT, True, "Brand"),
        ("unit_price", _REAL, False, "List price"),
        ("cost_price", T.DecimalType(12, 2), False, "Purchase cost per unit"),
        ("stock_qty", _LONG, True, "Units in stock"),
        ("is_active", _INT, True, "1 while the product is sold"),
    ),
    "orders": _table(
        ("order_id", _LONG, False, "Order key"),
        ("customer_id", _LONG, False, "Buying customer"),
        ("order_date", _DATE, False, "Day of the order"),
        ("status", _TEXT, True, "Fulfilment state"),
        ("payment_mode", _TEXT, True, "How the order was paid"),
        ("channel", _TEXT, True, "Where the order was placed"),
        ("discount_pct", _REAL, True, "Order discount as a fraction"),
        ("shipping_cost", _REAL, True, "Shipping fee, not part of the total"),
        ("total_amount", T.DecimalType(18, 2), True, "Sum of the order's line revenue"),
        ("city", _TEXT, True, "Delivery city"),
        ("state", _TEXT, True, "Delivery state"),
    ),
    "order_items": _table(
        ("item_id", T.DecimalType(38, 0), False, "Order line key"),
        ("order_id", _LONG, False, "Order of the line"),
        ("product_id", _LONG, False, "Product of the line"),
        ("quantity", _LONG, False, "Units bought"),
        ("unit_price", _REAL, False, "Price per unit before discount"),
        ("discount_pct", _REAL, True, "Line discount as a fraction"),
        ("line_revenue", T.DecimalType(18, 4), False, "Price times quantity after discount"),
    ),
    "returns": _table(
        ("return_id", _LONG, False, "Return key"),
        ("order_id", _LONG, False, "Returned order"),
        ("return_date", _DATE, False, "Day of the return"),
        ("reason", _TEXT, True, "Why it came back"),
        ("refund_amount", _REAL, True, "Money paid back"),
        ("status", _TEXT, True, "State of the claim"),
    ),
}

TABLE_NAMES = list(SCHEMAS)

PRIMARY_KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "item_id",
    "returns": "return_id",
}

UNIQUE = {"customers": ["email"]}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("returns", "order_id", "orders", "order_id"),
]

DOMAINS = {
    ("customers", "segment"): SEGMENTS,
    ("customers", "is_active"): [0, 1],
    ("products", "is_active"): [0, 1],
    ("orders", "status"): ORDER_STATUSES,
    ("returns", "status"): RETURN_STATUSES,
}

POSITIVE = [("products", "unit_price"), ("products", "cost_price"), ("order_items", "quantity")]
