from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from tests.llm import plain

from tradelens.llm import variants


def _words(rows):
    counted = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{d}:{run}".encode())
            if d is not None and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counted[run] += 1
    return {w: n for w, n in counted.items() if len(w) >= 7 and n >= 2}


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def _by_plain(rows):
    found = _words(rows)
    near = {a: [b for b in found if _near(a, b)] for a in found}
    form = {}
    for a, others in near.items():
        best = min(others, key=lambda b: (-found[b], b), default=None)
        form[a] = best if best and found[best] >= 10 * found[a] else None
    out = []
    for a in found:
        root = a
        while form[root]:
            root = form[root]
        out.append((a, form[a], root, found[a], len(near[a]), found[form[a]] if form[a] else None))
    return plain.by_text(out)


def _made():
    rng = random.Random(7)
    letters = "abÀé"
    base = ["".join(rng.choices(letters, k=rng.randint(6, 10))) for _ in range(250)]
    base += ["aaaaaaa" + "a" * k for k in range(9)] + ["spelling", "speling", "spellings", "Spelling"]
    rows = []
    for i in range(900):
        some = rng.choices(base, weights=[2 ** (k % 9) for k in range(len(base))], k=rng.randint(0, 25))
        some = [w[:k] + rng.choice(letters) + w[k + 1:] if rng.random() < .2 and (k := rng.randrange(len(w))) >= 0
                else w for w in some]
        rows.append((i if i % 10 else None, rng.choice([" ", "-", "1", "×" if i % 2 else "_"]).join(some)))
    rows += [(2000 + i, " ".join(["xxabcdefg"] * 9 + ["xyabcdefg"] * (i % 2) + ["yyabcdefg"] * (i < 3)))
             for i in range(90)]
    return rows + [(5, None), (6, ""), (7, "z" * 6000), (8, "z" * 6000), (9, "z" * 6001), (11, "z" * 6001)] * 2


def test_variants_by_comparing_all_words(spark):
    rows = _made()
    docs = spark.createDataFrame([(*r, "w", 0) for r in rows], "doc_id bigint, text string, word string, n int")
    for parts in (1, 5):
        got = variants.variants(docs.repartition(parts)).collect()
        assert plain.by_text([tuple(r) for r in got]) == _by_plain(rows)
    assert any(r.root != r.form and r.form for r in got)  # chains occur


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = variants.variants(docs).collect()
    found = _words(rows)
    assert {r.word: r.n for r in got} == found
    some = random.Random(1).sample(sorted(found), min(len(found), 150))
    near = {w: sum(_near(w, x) for x in found) for w in some}
    assert {r.word: r.n_near for r in got if r.word in near} == near


def test_masks_may_collide(spark, monkeypatch):
    """Nodes of one hash are one node; the letters decide."""
    monkeypatch.setattr(variants, "_node", lambda side, read: variants.F.xxhash64(side, read) % 40)
    rows = [(i, "".join(random.Random(i % 60).choices("abc", k=8))) for i in range(400)]
    got = variants.variants(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert plain.by_text([tuple(r) for r in got]) == _by_plain(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "short one"), (2, "lonelyword")]])
def test_nothing_to_find(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert variants.variants(docs).collect() == []
