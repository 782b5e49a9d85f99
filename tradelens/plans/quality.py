"""Data preparation and quality reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelens.functions.numeric import half_up, money, real
from tradelens.operators.keys import duplicate_keys, orphans, sample_rows
from tradelens.operators.ordering import number_within
from tradelens.plans.common import RETURNED, delivered
from tradelens.sources import schema
from tradelens.sources.tables import Tables, fill_totals

CENT = 0.01  # what a stored amount may be off by rounding

AUDITED = {"customers": ["email", "city", "segment"],
           "orders": ["total_amount", "payment_mode", "channel"]}


def _stored(tables: Tables, name: str, *columns: str) -> DataFrame:
    return tables.raw_orders(*columns) if name == "orders" else tables.table(name, *columns)


def _stack_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def null_audit(tables: Tables) -> DataFrame:
    """Null counts of three columns per table; the first table names the columns."""
    names = [f"null_{c}" for c in AUDITED["customers"]]

    def one(table: str) -> DataFrame:
        counts = [F.count_if(F.col(c).isNull()).alias(n) for c, n in zip(AUDITED[table], names)]
        return _stored(tables, table, *AUDITED[table]).agg(F.lit(table).alias("tbl"), *counts)

    return one("customers").union(one("orders"))


def null_counts(tables: Tables, audited: dict[str, list[str]] = AUDITED) -> DataFrame:
    """The same audit as (tbl, column, nulls)."""
    def one(table: str, columns: list[str]) -> DataFrame:
        counts = [F.count_if(F.col(c).isNull()).alias(c) for c in columns]
        return (_stored(tables, table, *columns).agg(*counts)
                .unpivot([], columns, "column", "nulls").withColumn("tbl", F.lit(table)))
    return _stack_all([one(t, c) for t, c in audited.items()]).select("tbl", "column", "nulls")


def fill_null_totals(tables: Tables) -> DataFrame:
    filled = fill_totals(tables.raw_orders("order_id", "total_amount"))
    return filled.select("order_id", money("total_amount").alias("total_amount"))


def order_outliers(tables: Tables, limit: float = 3.0) -> DataFrame:
    """Delivered orders more than ``limit`` population standard deviations from the mean."""
    orders = delivered(tables, "order_id", "total_amount")
    amount = F.col("total_amount").cast("double")
    stats = orders.select(amount.alias("x")).agg(
        F.struct(F.avg("x").alias("mean"), F.stddev_pop("x").alias("spread")))
    scored = orders.withColumn("s", stats.scalar()).withColumn(
        "z", F.try_divide(amount - F.col("s.mean"), F.col("s.spread")))
    return scored.where(F.abs("z") > limit).select(
        "order_id", money("total_amount").alias("total_amount"),
        half_up(F.col("z"), 2).alias("z_score"))


def duplicate_orders(tables: Tables) -> DataFrame:
    return duplicate_keys(tables.raw_orders("order_id"), ["order_id"])


def duplicate_lines(tables: Tables) -> DataFrame:
    """Products that appear more than once in one order."""
    return duplicate_keys(tables.order_items("order_id", "product_id"), ["order_id", "product_id"])


def orphan_items(tables: Tables) -> DataFrame:
    items = tables.order_items("item_id", "order_id")
    return orphans(items, tables.raw_orders("order_id"), "order_id").select("item_id", "order_id")


def orders_without_items(tables: Tables) -> DataFrame:
    return orphans(tables.raw_orders("order_id"), tables.order_items("order_id"), "order_id",
                   parent_is_unique=False)


def order_totals(tables: Tables) -> DataFrame:
    """Every order with the sum of its lines, zero where it has none."""
    sums = tables.order_items("order_id", "line_revenue").groupBy("order_id") \
        .agg(F.sum("line_revenue").alias("total"))
    joined = tables.raw_orders("order_id").join(sums, "order_id", "left")
    amount = F.coalesce(F.round("total", 2), F.lit(0).cast("decimal(18,2)"))
    return joined.select("order_id", amount.cast("double").alias("total_amount"))


def line_revenue(tables: Tables) -> DataFrame:
    """Quantity x price less discount, to the cent, next to the stored amount."""
    lines = tables.order_items("order_id", "product_id", "quantity", "unit_price",
                               "discount_pct", "line_revenue")
    gross = (F.col("quantity") * F.col("unit_price")).cast("decimal(18,4)")
    kept = F.lit(1).cast("decimal(5,4)") - F.col("discount_pct").cast("decimal(5,4)")
    return lines.select("order_id", "product_id", "quantity",
                        money(gross * kept).alias("computed_revenue"),
                        money("line_revenue", 4).alias("line_revenue"))


def returned_orders(tables: Tables) -> DataFrame:
    """The orders a return belongs to, with the return's date where one is recorded."""
    orders = tables.raw_orders("order_id", "customer_id", "order_date", statuses=[RETURNED])
    returns = tables.returns("order_id", "return_date")
    days = F.datediff("return_date", "order_date").cast("bigint")
    return orders.join(returns, "order_id", "left").withColumn("days_to_return", days)


def numbered_lines(tables: Tables) -> DataFrame:
    """Distinct products of each order, numbered from 1: a key built from the parent's key."""
    lines = tables.order_items("order_id", "product_id").distinct()
    return number_within(lines, "order_id", ["product_id"], "line_no")


def sample_orders(tables: Tables, rows: int = 200, seed: int = 42) -> DataFrame:
    """A fixed random sample of delivered orders without replacement."""
    orders = delivered(tables, "order_id", "total_amount")
    return sample_rows(orders, rows, "order_id", seed).select(
        "order_id", money("total_amount").alias("total_amount"))


def _label(rule: str, table: str, column: str) -> str:
    return f"{rule}:{table}:{column}"


def _as_rules(counted: DataFrame) -> DataFrame:
    """One row of counts, named by ``_label``, turned into report rows."""
    long = counted.unpivot([], counted.columns, "label", "violations")
    parts = [F.split_part("label", F.lit(":"), F.lit(i)).alias(name)
             for i, name in enumerate(["rule", "table", "column"], 1)]
    count = F.coalesce(F.col("violations").cast("bigint"), F.lit(0)).alias("violations")
    return long.select(*parts, count)


def _row_checks(tables: Tables, table: str) -> list[tuple[str, str, Column]]:
    """(rule, column, broken) of every rule that one row can break; keys are checked elsewhere."""
    present = set(tables.columns(table)) - {schema.PRIMARY_KEYS[table]}
    checks: list[tuple[str, str, Column]] = []
    for field in schema.SCHEMAS[table]:
        if not field.nullable and field.name in present:
            checks.append(("not_null", field.name, F.col(field.name).isNull()))
    for (where, column), allowed in schema.DOMAINS.items():
        if where == table and column in present:
            checks.append(("allowed_values", column, ~F.col(column).isin(allowed)))
    for where, column in schema.POSITIVE:
        if where == table and column in present:
            checks.append(("positive", column, ~(F.col(column) > 0)))
    if table == "order_items" and LINE_AMOUNT <= present:
        expected = F.col("quantity") * F.col("unit_price") * (1 - F.col("discount_pct"))
        off = F.abs(real("line_revenue") - expected) > CENT
        checks.append(("line_amount", "line_revenue", off))
    return checks


LINE_AMOUNT = {"quantity", "unit_price", "discount_pct", "line_revenue"}
OWN, BROKEN = "own", "broken"  # roles; a child's is "table.column"
# Figures of an order that its lines are held against.
AMOUNTS = {"orders": ("total_amount", "discount_pct"), "order_items": ("line_revenue", "discount_pct")}


def _entries(tables: Tables, table: str) -> DataFrame:
    """(place, key, role, amount, discount): what one scan of the table has to say.

    A row for each key value of each row, under the table it is a key of; orders and their lines
    bring their amounts along. A row for each rule a row breaks, under the rule's label.
    """
    amount_of = AMOUNTS.get(table)

    def entry(place: str, key: Column, role: str, amounts: bool = False) -> Column:
        amount, discount = (F.col(c) for c in amount_of) if amounts else (F.lit(None), F.lit(None))
        return F.struct(F.lit(place).alias("place"), key.cast("string").alias("key"),
                        F.lit(role).alias("role"), amount.cast("decimal(38,4)").alias("amount"),
                        discount.cast("double").alias("discount"))

    own = schema.PRIMARY_KEYS[table]
    found, columns = [], []
    if (table, own) not in tables.generated:
        found.append(entry(table, F.col(own), OWN, table == "orders"))
        columns.append(own)
    for column in schema.UNIQUE.get(table, []):
        found.append(F.when(F.col(column).isNotNull(), entry(f"{table}.{column}", F.col(column), OWN)))
        columns.append(column)
    for child, column, parent, _ in schema.FOREIGN_KEYS:
        if child == table:
            to_order = (child, column) == ("order_items", "order_id")
            found.append(F.when(F.col(column).isNotNull(),
                                entry(parent, F.col(column), f"{child}.{column}", to_order)))
            columns.append(column)
    for rule, column, bad in _row_checks(tables, table):
        found.append(F.when(bad, entry(_label(rule, table, column), F.lit(None), BROKEN)))
        columns += [column, *(sorted(LINE_AMOUNT) if rule == "line_amount" else [])]
    read = list(dict.fromkeys([*columns, *(amount_of or ())]))
    rows = _stored(tables, table, *read)
    return rows.select(F.explode(F.array_compact(F.array(*found))).alias("e")).select("e.*")


def _key_and_row_rules(tables: Tables) -> DataFrame:
    """Keys, references, row rules, and orders against their lines, from one scan of each table.

    All tables' entries meet in one shuffle by key, counted before they move, so a hot key or a rule
    that every row breaks is one row a task.
    """
    def with_role(role: str) -> Column:
        return F.col("role") == role

    children = {(child, column): f"{child}.{column}" for child, column, *_ in schema.FOREIGN_KEYS}
    line = with_role(children["order_items", "order_id"])
    met = _stack_all([_entries(tables, name) for name in schema.TABLE_NAMES]).groupBy("place", "key").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(with_role(OWN)).alias(OWN),
        *[F.count_if(with_role(role)).alias(role) for role in children.values()],
        F.max(F.when(with_role(OWN), F.col("amount"))).alias("total"),
        F.sum(F.when(line, F.col("amount"))).alias("lines"),
        F.max(F.when(with_role(OWN), F.col("discount"))).alias("discount"),
        F.min(F.when(line, F.col("discount"))).alias("low"),
        F.max(F.when(line, F.col("discount"))).alias("high"))

    def at(place: str) -> Column:
        return F.col("place") == place

    has_key, own = F.col("key").isNotNull(), F.col(OWN)
    repeated = has_key & (own > 1)
    counts: dict[str, Column] = {}
    for table, column in schema.PRIMARY_KEYS.items():
        counts[_label("primary_key", table, column)] = F.count_if(at(table) & repeated)
        counts[_label("not_null", table, column)] = F.sum(F.when(at(table) & ~has_key, own))
    for table, columns in schema.UNIQUE.items():
        for column in columns:
            counts[_label("unique", table, column)] = F.count_if(at(f"{table}.{column}") & repeated)
    for child, column, parent, _ in schema.FOREIGN_KEYS:
        lost = at(parent) & has_key & (own == 0)
        counts[_label("foreign_key", child, column)] = F.sum(F.when(lost, F.col(f"`{child}.{column}`")))
    for table in schema.TABLE_NAMES:
        for rule, column, _ in _row_checks(tables, table):
            label = _label(rule, table, column)
            counts[label] = F.sum(F.when(at(label), F.col("rows")))
    known = at("orders") & (own > 0)

    def differs(side: str) -> Column:
        return F.round(F.col(side) * 100) != F.round(F.col("discount") * 100)

    sum_of_lines = F.coalesce(F.round("lines", 2), F.lit(0).cast("decimal(18,2)"))
    off = F.coalesce("total", F.lit(0)) != sum_of_lines
    counts[_label("sum_of_lines", "orders", "total_amount")] = F.count_if(known & off)
    counts[_label("order_discount", "order_items", "discount_pct")] = \
        F.count_if(known & (differs("low") | differs("high")))
    counts[_label("one_per_order", "returns", "order_id")] = \
        F.count_if(at("orders") & has_key & (F.col("`returns.order_id`") > 1))
    return _as_rules(met.agg(*[count.alias(label) for label, count in counts.items()]))


def _return_rules(tables: Tables) -> DataFrame:
    """Returns of an order that is not Returned, or on an impossible day."""
    orders = tables.raw_orders("order_id", "order_date", "status")
    both = tables.returns("order_id", "return_date").join(orders, "order_id")
    late = ~F.datediff("return_date", "order_date").between(1, 15)
    return _as_rules(both.agg(
        F.count_if(F.col("status") != RETURNED).alias(_label("of_returned_order", "returns", "order_id")),
        F.count_if(late).alias(_label("days_after_order", "returns", "return_date"))))


def _registration_rule(tables: Tables) -> DataFrame:
    """Orders from before their customer's registration."""
    people = tables.customers("customer_id", "registration_date")
    both = tables.raw_orders("customer_id", "order_date").join(people, "customer_id")
    early = F.col("order_date") < F.col("registration_date")
    return _as_rules(both.agg(
        F.count_if(early).alias(_label("after_registration", "orders", "order_date"))))


def _not_checked(tables: Tables) -> list[tuple[str, str, str]]:
    """Rules on columns that the source does not have."""
    def lacks(table: str, column: str) -> bool:
        return column not in tables.columns(table)

    found = [("not_null", table, field.name) for table in schema.TABLE_NAMES
             for field in schema.SCHEMAS[table] if not field.nullable and lacks(table, field.name)]
    found += [("allowed_values", *key) for key in schema.DOMAINS if lacks(*key)]
    found += [("positive", *key) for key in schema.POSITIVE if lacks(*key)]
    if lacks("customers", "registration_date"):
        found.append(("after_registration", "orders", "order_date"))
    return found


def constraint_report(tables: Tables) -> DataFrame:
    """Violations of every declared constraint: (rule, table, column, violations).

    Keys count the values that occur more than once, the others count rows. On top come: an order's
    total is the sum of its lines, a line's revenue follows from price, quantity and discount, a
    line has its order's discount (counted by order), a return follows its order by 1 to 15 days,
    belongs to a Returned order and is the only one of it, and no order is older than its customer's
    registration. Rules on columns that the source lacks are listed with NULL: not checked.
    """
    reports = [_key_and_row_rules(tables), _return_rules(tables)]
    open_rules = _not_checked(tables)
    if ("after_registration", "orders", "order_date") not in open_rules:
        reports.append(_registration_rule(tables))
    if open_rules:
        spark = reports[0].sparkSession
        reports.append(spark.createDataFrame(
            [(*rule, None) for rule in open_rules],
            "`rule` string, `table` string, `column` string, `violations` bigint"))
    return _stack_all(reports)


def table_profile(tables: Tables) -> DataFrame:
    """Rows, columns and total nulls of each table."""
    def one(table: str) -> DataFrame:
        columns = tables.columns(table)
        key = schema.PRIMARY_KEYS[table]
        # item_id may be derived by numbering an order's lines; it is never null then or otherwise
        counted = [c for c in columns if c != key]
        nulls = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in counted])
        return _stored(tables, table, *counted).agg(
            F.lit(table).alias("table"), F.count(F.lit(1)).alias("rows"),
            F.lit(len(columns)).cast("bigint").alias("columns"), nulls.alias("nulls"))
    return _stack_all([one(name) for name in schema.TABLE_NAMES])
