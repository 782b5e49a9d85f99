"""Sinks: what is written comes back, failures leave the old data, an update leaves other partitions."""

from __future__ import annotations

from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tests.micro import make

import __spark_entry__ as driver
from tradelens.plans.report import export_tables, save_tables
from tradelens.sources import stored
from tradelens.sources.bound import StarTables
from tradelens.sources.schema import SCHEMAS, TABLE_NAMES
from tradelens.sources.tables import Tables

ODD = ['a "quoted", text', "two\nlines", "", None, " spaces ", "é,;\t", "\\", '"']


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_odd_values_come_back(spark, tmp_path, kind):
    people = [{"customer_id": i, "email": f"{i}@x", "city": city} for i, city in enumerate(ODD)]
    t = make(spark, customers=people, orders=[{"order_id": 1, "total_amount": None}, {"order_id": 2}],
             order_items=[{"item_id": 10 ** 30, "order_id": 1}])
    folder = str(tmp_path / "out")
    export_tables(t, folder, kind)
    back = Tables.from_csv(spark, folder) if kind == "csv" else Tables.from_parquet(spark, folder)
    for name in TABLE_NAMES:
        mine, theirs = (sorted(map(str, x.raw_orders().collect() if name == "orders" else x.table(name).collect()))
                        for x in (t, back))
        assert theirs == (sorted(row.replace("city=''", "city=None") for row in mine) if kind == "csv" else mine)
        assert stored.verify(spark, f"{folder}/{name}")["rows"] == len(mine)
    assert back.raw_orders().where("total_amount IS NULL").count() == 1


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_derived_tables_are_exported_in_schema_types(spark, tmp_path, kind):
    star = StarTables(spark, "/root/testdata/sf0.001")
    export_tables(star, str(tmp_path), kind)
    back = Tables.from_csv(spark, str(tmp_path)) if kind == "csv" else Tables.from_parquet(spark, str(tmp_path))
    for name in TABLE_NAMES:
        assert [f.dataType for f in back.table(name).schema] == [f.dataType for f in SCHEMAS[name]]
    ids = star.order_items("item_id").exceptAll(back.order_items("item_id"))
    assert ids.count() == 0 and back.order_items().count() == star.row_count("order_items")


def test_a_failed_write_leaves_the_old_data(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    stored.replace(spark.range(5), path)
    fails = spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        stored.replace(fails, path)
    with pytest.raises(ValueError):
        stored.replace(spark.range(3), path, "avro")
    monkeypatch.setattr(stored, "read", lambda spark, *_: spark.range(2))
    with pytest.raises(stored.ReadBackError):
        stored.replace(spark.range(9), path)
    monkeypatch.undo()
    assert stored.verify(spark, path)["rows"] == 5 == spark.read.parquet(path).count()
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]


def test_a_failed_swap_puts_the_old_data_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    stored.replace(spark.range(5), path)
    move = stored._Folders.move

    def broken(self, source, target):
        if ".staged-" in source:
            raise OSError("gone")
        move(self, source, target)
    monkeypatch.setattr(stored._Folders, "move", broken)
    with pytest.raises(OSError):
        stored.replace(spark.range(9), path)
    assert spark.read.parquet(path).count() == 5


def test_changed_data_are_noticed(spark, tmp_path):
    path = str(tmp_path / "t")
    stored.replace(spark.range(100), path)
    spark.range(1).write.mode("append").parquet(path)
    with pytest.raises(stored.ReadBackError):
        stored.verify(spark, path)


def test_update_rewrites_only_months_with_a_missing_total(spark, tmp_path):
    days = [date(2024, 1, 5), date(2024, 2, 5), date(2024, 3, 5), date(2024, 4, 5)]
    t = make(spark, orders=[{"order_id": i, "order_date": days[i % 4],
                             "total_amount": None if i in (1, 5, 7) else Decimal(i)} for i in range(40)])
    path = str(tmp_path / "orders")
    stored.store_orders(t, path)

    def files():
        return {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    before = files()
    assert stored.stored_orders(spark, path).where("total_amount IS NULL").count() == 3
    assert stored.fill_stored_totals(spark, path) == ["2024-02", "2024-04"]
    after = files()
    kept = {f for f in before if "2024-01" in str(f) or "2024-03" in str(f)}
    assert kept and all(after.get(f) == before[f] for f in kept)
    assert not (set(before) - kept) & set(after)
    rows = {r["order_id"]: r["total_amount"] for r in stored.stored_orders(spark, path).collect()}
    assert rows == {i: Decimal(0 if i in (1, 5, 7) else i) for i in range(40)}
    assert stored.fill_stored_totals(spark, path) == [] and files() == after


def test_catalog_tables_have_one_file_a_bucket(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS stored_test")
    try:
        save_tables(StarTables(spark, "/root/testdata/sf0.001"), "stored_test")
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert len(spark.table("stored_test.order_items").inputFiles()) == buckets
        a, b = (spark.table(f"stored_test.{n}") for n in ("orders", "order_items"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = a.join(b, "order_id")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE stored_test CASCADE")


def test_cube_holds_what_the_slicers_give(spark):
    from tradelens.plans import measures
    tables = StarTables(spark, "/root/testdata/sf0.001")
    cube = {(r["open"], r["year"], r["segment"], r["channel"]): r
            for r in measures.slicer_cube(tables).where("state IS NULL AND status IS NULL").collect()}
    for slicers, key in ((measures.Slicers(), (31, None, None, None)),
                         (driver.measures.Slicers(years=(1997,), segments=("BUILDING",)), (7, 1997, "BUILDING", None)),
                         (measures.Slicers(channels=("Website",)), (30, None, None, "Website"))):
        card = measures.page_cards(measures.sliced(tables, slicers)).first()
        assert cube[key]["revenue"] == card["total_revenue"]
        assert cube[key]["active_customers"] == card["active_customers"]
