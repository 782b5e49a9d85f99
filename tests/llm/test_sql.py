"""Operators that SQL can express, against DuckDB, on the given tables and on odd ones."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F
from tests.compare import differences
from tests.llm import plain

from tradelens.llm import mixing, queries, reputation

FOLDER = "/root/testdata/sf0.01"
TABLES = ["documents", "pages", "labels"]


def _duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'"
                    if folder != FOLDER else f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_given_tables(spark, name):
    mine = queries.QUERIES[name](spark, FOLDER).toArrow()
    assert differences(mine, _duck(FOLDER).sql(queries.ORACLES[name]).to_arrow_table()) == []


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(plain.odd_documents(n=50), plain.DOCS).write.parquet(f"{folder}/documents.parquet")
    urls = [None, "", "nothing", "http://", "HTTP://Www.Example.NET/en/1", "http://example.net/en",
            "https://a.example.com/de/12.html", "https://a.example.com/de/13/?x=://b", "ftp://org/fr/3",
            "http://x.org/fr/4#f", "http://x.org?q", "http://x.org#/fr/", "a://b.c/7", "http://bad.co/5",
            "http://bad.co/6", "http://bad.co/8", "http://bad.co/9", "://é.net", "http://net", "http://a.net:80/x"]
    pages = [(i % 17 if i else None, u, "<html>") for i, u in enumerate(urls * 2)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string") \
        .write.parquet(f"{folder}/pages.parquet")
    labels = [(i, 0, 1) for i in (5, 6, 8, 9)] + [(1, 1, 0), (1, 0, 0), (12, None, None), (3, 1, None),
                                                  (None, 0, 1), (4, 1, 0), (7, 1, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int") \
        .write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.mark.parametrize("name", ["op8_url_filter", "op9_mixing"])
def test_odd_tables(spark, odd, name):
    mine = queries.QUERIES[name](spark, odd).toArrow()
    assert mine.num_rows
    assert differences(mine, _duck(odd).sql(queries.ORACLES[name]).to_arrow_table()) == []


def test_targets_are_reached(spark):
    out = mixing.mix(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    largest = out.agg(F.max("size")).first()[0]
    for r in out.groupBy("source", "target").agg(F.sum("taken").alias("taken")).collect():
        assert abs(r.taken - r.target) <= largest / 2
    assert out.where("taken > 2 * size OR taken < 0").count() == 0
    assert sorted(map(str, out.collect())) == sorted(map(str, out.collect()))


def test_lower_budgets_take_subsets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    less = {r.doc_id for r in mixing.mix(docs, (1,), 0.3).where("taken > 0").collect()}
    more = {r.doc_id for r in mixing.mix(docs, (1,), 0.6).where("taken > 0").collect()}
    assert less < more


def test_documents_of_the_mix(spark):
    docs = spark.createDataFrame(plain.odd_documents(n=40), plain.DOCS).withColumns(
        {"hash": F.lit(1), "of": F.lit(2), "rounds": F.lit(3), "row": F.lit(4)})
    out = mixing.mixed(docs)
    assert out.columns == [*docs.columns, "size", "target", "taken"]
    taken = mixing.mix(docs).where("taken > 0")
    assert out.select("doc_id", "source", "size", "taken").exceptAll(
        taken.select("doc_id", "source", "size", "taken")).count() == 0
    assert out.count() == taken.count()


def test_empty_tables(spark):
    docs = spark.createDataFrame([], plain.DOCS)
    assert mixing.mix(docs).collect() == mixing.mixed(docs).collect() == []
    pages = spark.createDataFrame([("x", 1)], "url string, page_id int").limit(0)
    told = spark.createDataFrame([], "host string, bad bigint")
    assert reputation.judge(pages, told).collect() == []


def test_bad_hosts_are_blocked_and_unknown_ones_lean_on_their_domain(spark):
    hosts = [f"h{i}.good.example" for i in range(20)] + [f"h{i}.bad.example" for i in range(20)]
    told = [(h, int("bad" in h)) for h in hosts for _ in range(30)]
    pages = [(i, f"http://{h}/x") for i, h in enumerate([*hosts, "new.bad.example", "new.good.example"])]
    out = reputation.judge(spark.createDataFrame(pages, "page_id int, url string"),
                           spark.createDataFrame(told, "host string, bad bigint"), rules=())
    assert {r.host: r.verdict for r in out.collect()} == {
        h: "block" if "bad" in h else "allow" for h in [*hosts, "new.bad.example", "new.good.example"]}


def test_no_python_in_native_plans(spark, odd, capsys):
    queries.QUERIES["op8_url_filter"](spark, odd).explain("formatted")
    assert not [x for x in ("Python", "Pandas", "Arrow") if x in capsys.readouterr().out]
