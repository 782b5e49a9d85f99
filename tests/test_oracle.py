"""Every query against its SQL on the test tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from tests.compare import connect, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {name: query for name, query in driver.queries().items() if name in driver.ANALYSES}
ORACLES = {name: sql for name, sql in driver.oracle_sql().items() if name in driver.ANALYSES}

# Results that are empty on the test tables, which have no such rows.
EMPTY = {"duplicate_orders", "orphan_items"}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    mine = QUERIES[name](spark, FOLDER).toArrow()
    theirs = duck.sql(ORACLES[name]).to_arrow_table()
    assert differences(mine, theirs) == []
    assert mine.num_rows > 0 or name in EMPTY


def test_entry(spark):
    assert driver.entry(spark).count() > 0
