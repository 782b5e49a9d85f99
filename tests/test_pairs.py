from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import pytest

from tradelens.operators.pairs import ordered_label_pairs


def brute_force(rows):
    counts, groups = Counter(), {}
    for g, o, label in rows:
        groups.setdefault(g, []).append((o, label))
    for lines in groups.values():
        counts.update((a, b) for (_, a), (_, b) in combinations(sorted(lines), 2))
    return dict(counts)


def run(spark, rows, parts=None):
    df = spark.createDataFrame(rows, "g bigint, o bigint, label string")
    got = ordered_label_pairs(df, "g", "o", "label").collect()
    return {(r["a"], r["b"]): r["n"] for r in got}


@pytest.mark.parametrize("seed", range(4))
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randint(1, 40), i, rng.choice("abcd")) for i in range(400)]
    assert run(spark, rows) == brute_force(rows)


def test_one_group_holds_most_rows(spark):
    rng = random.Random(7)
    rows = [(5 if i % 3 else rng.randint(1, 30), i, rng.choice("abc")) for i in range(3000)]
    assert run(spark, rows) == brute_force(rows)


def test_one_group_only(spark):
    rows = [(1, i, "ab"[i % 2]) for i in range(1000)]
    assert run(spark, rows) == brute_force(rows)


def test_levels_of_a_hot_group_numbered_by_several_tasks(spark):
    rng = random.Random(1)
    rows = [(rng.choice([1, 1, 2, rng.randint(3, 25)]), i, rng.choice("abcde")) for i in range(1200)]
    df = spark.createDataFrame(rows, "g bigint, o bigint, label string")
    got = {(r["a"], r["b"]): r["n"] for r in ordered_label_pairs(df, "g", "o", "label", hot=100).collect()}
    assert got == brute_force(rows)


def test_no_python_worker(spark):
    rows = [(1, i, "ab"[i % 2]) for i in range(100)]
    df = spark.createDataFrame(rows, "g bigint, o bigint, label string")
    plan = ordered_label_pairs(df, "g", "o", "label")._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan


def test_empty_and_single_rows(spark):
    assert run(spark, []) == {}
    assert run(spark, [(1, 1, "a"), (2, 2, "b")]) == {}


def test_missing_groups_and_large_ids(spark):
    big = (1 << 53) + 1
    rows = [(None, 1, "a"), (None, 2, "b"), (big, 1, "a"), (big, 2, "b"), (big + 1, 1, "b"), (big + 1, 2, "c")]
    assert run(spark, rows) == {("a", "b"): 1, ("b", "c"): 1}


def test_very_many_labels(spark):
    rows = [(i // 3, i, f"l{i % 10_000}") for i in range(30_000)]
    assert run(spark, rows) == brute_force(rows)


def test_groups_of_any_type(spark):
    df = spark.createDataFrame([("x", 1, "a"), ("x", 2, "b"), ("y", 1, "a")], "g string, o bigint, label string")
    assert [tuple(r) for r in ordered_label_pairs(df, "g", "o", "label").collect()] == [("a", "b", 1)]
