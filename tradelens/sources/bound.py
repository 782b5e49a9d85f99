"""The canonical tables derived from a TPC-H-like star (customer, nation, part, orders, lineitem).

Columns that the star lacks follow fixed rules on its keys. Each accessor builds only the joins
the asked-for columns need: order totals need the lines, an order's place needs its customer,
an order's status needs neither.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.operators.ordering import number_within
from tradelens.sources.schema import RETURN_REASONS
from tradelens.sources.tables import LINE_SEQ, Tables

STAR = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, "
                "l_shipdate timestamp_ntz",
}

COLUMNS = {
    "customers": ["customer_id", "first_name", "last_name", "email", "city", "state", "segment"],
    "products": ["product_id", "product_name", "category", "brand", "unit_price", "cost_price"],
    "orders": ["order_id", "customer_id", "order_date", "status", "payment_mode", "channel",
               "discount_pct", "total_amount", "city", "state"],
    "order_items": ["item_id", "order_id", "product_id", "quantity", "unit_price",
                    "discount_pct", "line_revenue"],
    "returns": ["return_id", "order_id", "return_date", "reason"],
}

DRIVING = {"customers": "customer", "products": "part", "orders": "orders",
           "order_items": "lineitem", "returns": "orders"}

# An order's lines are numbered from 1; no order reaches the next one's numbers.
ITEM_STEP = Decimal(10 ** 18)

# Identifies a line within its order; (order, line number) alone is not unique.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
              "l_quantity"]


# The stored code behind each status: a test on it reaches the file scan, one on the rule cannot.
CODES = {"Delivered": "F", "Cancelled": "O", "Shipped": "O", "Returned": "P", "Processing": "P"}


def _hundredths(value: Column) -> Column:
    """A two-digit amount held as a double, as a whole number of hundredths."""
    return F.floor(value * 100 + 0.5)


def _revenue_units() -> Column:
    """Price times (1 - discount) in units of 0.0001, exact and in plain long arithmetic."""
    return _hundredths(F.col("l_extendedprice")) * (100 - _hundredths(F.col("l_discount")))


def _from_units(units: Column) -> Column:
    return units.cast("decimal(20,0)") * F.lit(Decimal("0.0001"))


def line_revenue() -> Column:
    return _from_units(_revenue_units()).cast("decimal(18,4)")


def order_status() -> Column:
    third = F.col("o_orderkey") % 3 == 0
    state = F.col("o_orderstatus")
    return (F.when(state == "F", "Delivered")
            .when(state == "O", F.when(third, "Cancelled").otherwise("Shipped"))
            .when(state == "P", F.when(third, "Returned").otherwise("Processing")))


class StarTables(Tables):
    def __init__(self, spark: SparkSession, folder: str):
        super().__init__({name: spark.read.schema(ddl).parquet(f"{folder}/{name}.parquet")
                          for name, ddl in STAR.items()})

    generated = frozenset({("order_items", "item_id")})

    def columns(self, name: str) -> list[str]:
        return COLUMNS[name]

    def smallest(self, name: str) -> DataFrame:
        """The smallest item_id is the first line of the smallest order: no line need be numbered."""
        if name != "order_items":
            return super().smallest(name)
        names = [c for c in COLUMNS[name] if c != "item_id"]
        found = self.order_items(*names).agg(*[F.min(c).cast("string").alias(c) for c in names])
        first = (F.col("order_id").cast("decimal(19,0)") * ITEM_STEP + 1).cast("decimal(38,0)").cast("string")
        return found.withColumn("item_id", first).select(*COLUMNS[name])

    def row_count(self, name: str) -> int:
        return super().row_count(DRIVING[name])

    def customers(self, *columns: str) -> DataFrame:
        columns = columns or tuple(COLUMNS["customers"])
        df = self._frames["customer"]
        if {"city", "state"} & set(columns):
            df = df.join(self._frames["nation"], F.col("c_nationkey") == F.col("n_nationkey"),
                         "left")
        key = F.col("c_custkey")
        rules = {
            "customer_id": key,
            "first_name": F.split_part("c_name", F.lit("#"), F.lit(1)),
            "last_name": F.split_part("c_name", F.lit("#"), F.lit(2)),
            "email": F.when(key % 50 != 0,
                            F.concat(F.lit("customer"), key.cast("string"),
                                     F.lit("@example.com"))),
            "city": F.col("n_name"),
            "state": F.col("n_name"),
            "segment": F.col("c_mktsegment"),
        }
        return df.select(*[rules[c].alias(c) for c in columns])

    def products(self, *columns: str) -> DataFrame:
        rules = {
            "product_id": F.col("p_partkey"),
            "product_name": F.col("p_name"),
            "category": F.col("p_type"),
            "brand": F.col("p_brand"),
            "unit_price": F.col("p_retailprice"),
            "cost_price": F.col("p_retailprice").cast("decimal(12,2)"),
        }
        return self._frames["part"].select(
            *[rules[c].alias(c) for c in columns or COLUMNS["products"]])

    def order_items(self, *columns: str) -> DataFrame:
        columns = columns or tuple(COLUMNS["order_items"])
        rules = {
            LINE_SEQ: F.struct(*LINE_ORDER),
            "order_id": F.col("l_orderkey"),
            "product_id": F.col("l_partkey"),
            "quantity": F.col("l_quantity").cast("bigint"),
            "unit_price": F.col("l_extendedprice") / F.col("l_quantity"),
            "discount_pct": F.col("l_discount"),
            "line_revenue": line_revenue(),
        }
        lines = self._frames["lineitem"]
        if "item_id" not in columns:
            return lines.select(*[rules[c].alias(c) for c in columns])
        wanted = dict.fromkeys(["order_id", *columns])
        lines = lines.select(*LINE_ORDER, *[rules[c].alias(c) for c in wanted if c in rules])
        numbered = number_within(lines, "order_id", LINE_ORDER, "line_no")
        order, line = (F.col(c).cast("decimal(19,0)") for c in ("order_id", "line_no"))
        item_id = (order * ITEM_STEP + line).cast("decimal(38,0)")
        return numbered.withColumn("item_id", item_id).select(*columns)

    def order_totals(self) -> DataFrame:
        """Line revenue per order, summed before it meets the orders."""
        return (self._frames["lineitem"].groupBy(F.col("l_orderkey").alias("order_id"))
                .agg(F.round(_from_units(F.sum(_revenue_units())), 2).cast("decimal(18,2)")
                     .alias("total_amount")))

    def raw_orders(self, *columns: str, statuses: list[str] | None = None) -> DataFrame:
        columns = columns or tuple(COLUMNS["orders"])
        rules = {
            "order_id": F.col("o_orderkey"),
            "customer_id": F.col("o_custkey"),
            "order_date": F.col("o_orderdate").cast("date"),
            "status": order_status(),
            "payment_mode": F.col("o_orderpriority"),
            "channel": F.when(F.col("o_orderkey") % 10 < 5, "Mobile App")
                        .when(F.col("o_orderkey") % 10 < 9, "Website")
                        .otherwise("Mobile Web"),
            "discount_pct": F.col("o_custkey") % 5 * 5 / F.lit(100.0),
        }
        place = {"city", "state"} & set(columns)
        needs = set(columns) - place - {"total_amount"}
        if "total_amount" in columns:
            needs |= {"order_id"}
        if place:
            needs |= {"customer_id"}
        df = self._frames["orders"]
        if statuses is not None:
            codes = sorted({CODES[s] for s in statuses})
            df = df.where(F.col("o_orderstatus").isin(codes) & order_status().isin(statuses))
        df = df.select(*[rules[c].alias(c) for c in rules if c in needs])
        if "total_amount" in columns:
            df = df.join(self.order_totals(), "order_id", "left")
        if place:
            df = df.join(self.customers("customer_id", *sorted(place)), "customer_id", "left")
        return df.select(*columns)

    def returns(self, *columns: str) -> DataFrame:
        number = F.col("customer_id")
        reason = F.element_at(F.array(*map(F.lit, RETURN_REASONS)),
                              (number % len(RETURN_REASONS) + 1).cast("int"))
        rules = {
            "return_id": F.col("order_id"),
            "order_id": F.col("order_id"),
            "return_date": F.date_add("order_date", (number % 15 + 1).cast("int")),
            "reason": reason,
        }
        return (self.raw_orders("order_id", "customer_id", "order_date", statuses=["Returned"])
                .select(*[rules[c].alias(c) for c in columns or COLUMNS["returns"]]))
