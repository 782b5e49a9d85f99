from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm import plain

from tradelens.llm import neardup
from tradelens.llm.components import components

FOLDER = "/root/testdata/sf0.001"


def _rows(df):
    return plain.by_text([tuple(r) for r in df.collect()])


def test_documents_by_plain_comparison(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert _rows(neardup.near_duplicates(docs)) == plain.near_dups(rows)


def _edited(rng, words, n):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"e{rng.randrange(10**6)}"
    return words


def test_hub_with_copies_that_are_only_linked_by_others(spark):
    """Copies near the hub, copies of those, and a chain; the hub is not the smallest doc_id."""
    rng = random.Random(3)
    hub = [f"w{i}" for i in range(200)]
    rows, near = [], []
    for i in range(60):
        near.append(_edited(rng, hub, rng.randint(4, 12)))
        rows.append((100 + i, " ".join(near[-1])))
    for i in range(30):
        rows.append((10 + i, " ".join(_edited(rng, rng.choice(near), rng.randint(5, 11)))))
    rows.append((500, " ".join(hub)))
    rows += [(600, " ".join(hub).upper()), (601, "other text " * 30), (602, "OTHER text " * 90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    assert _rows(neardup.near_duplicates(docs)) == plain.near_dups(rows)


def test_odd_documents(spark):
    rows = plain.odd_documents(ids="unique") + [(None, "a b c d", "en", "s", 1), (None, None, None, None, 1)]
    docs = spark.createDataFrame(rows, plain.DOCS).withColumns(
        {"key": F.lit(1), "node": F.lit("x"), "gone": F.lit(2), "n": F.lit(3)})
    wanted = plain.near_dups([r[:2] for r in rows])
    assert _rows(neardup.near_duplicates(docs)) == wanted
    kept = neardup.unique(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in wanted if r[3])


def test_repeated_ids_and_empty_tables(spark):
    rows = plain.odd_documents()
    docs = spark.createDataFrame(rows, plain.DOCS)
    found = neardup.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.component_id is None) == (r.doc_id is None)
        assert r.doc_id is None or r.kept == (r.component_id == r.doc_id)
    assert neardup.near_duplicates(docs.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)]
    links += [(200 + i, 201 + i) for i in range(30)] + [(300, 300 + i) for i in range(1, 40)] + [(5, 5)]
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    linked = {x for a, b in links if a != b for x in (a, b)}
    found = components(spark.createDataFrame(links, "u bigint, v bigint"))
    assert sorted(map(tuple, found.collect())) == sorted((x, find(x)) for x in linked)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=30), st.lists(st.sampled_from("abcd"), max_size=30))
def test_similarity_is_exact(a, b):
    x, y = plain.shingles(" ".join(a)), plain.shingles(" ".join(b))
    if not (x and y):
        return
    mine = neardup.similar(neardup.shingles(" ".join(a).encode()), neardup.shingles(" ".join(b).encode()))
    assert mine == (100 * len(x & y) >= 80 * len(x | y))


def test_minima_estimate_the_similarity():
    rng = np.random.default_rng(1)
    a, b = neardup._family(neardup.BANDS * neardup.ROWS)
    off = []
    for _ in range(40):
        both = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
        x, y = neardup.minima(both[:800], a, b), neardup.minima(both[100:], a, b)
        off.append((x == y).mean() - 700 / 900)
        assert (x == y).sum() >= neardup.least_agreeing(78)
    assert abs(np.mean(off)) < 0.02
