"""The pipeline's stages, one after the other, against plain loops."""

from __future__ import annotations

import corpus_pipeline
from tests.llm import plain

from tradelens.llm import quality
from tradelens.llm.text import table
from tradelens.session import materialise

FOLDER = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.select(plain.COLUMNS).collect())


def test_stages_by_plain_loops(spark):
    docs = table(spark, FOLDER, "documents")
    rows = _rows(docs)
    stages = dict(corpus_pipeline.STAGES)

    def run(name):
        nonlocal docs
        docs = materialise(stages[name](spark, docs, FOLDER))
        return _rows(docs)

    verdicts = {r.doc_id: r.kept for r in quality.judge(docs, table(spark, FOLDER, "labels")).collect()}
    rows = [r for r in rows if verdicts[r[0]]]
    assert run("quality rules") == rows

    kept = {d for d, _, _, k in plain.near_dups([r[:2] for r in rows], width=corpus_pipeline.SHINGLE) if k}
    rows = [r for r in rows if r[0] in kept]
    assert run("near dedup") == rows

    cut = plain.without_repeats([r[:2] for r in rows])
    rows = [(r[0], t, r[2], r[3], len(t)) for r, t in zip(rows, cut)]
    assert run("suffix-array dedup") == rows

    items = [r.text for r in table(spark, FOLDER, "benchmark").collect()]
    leaks = [r for r in rows if any(i in r[1] for i in items)]
    left = run("benchmark decontamination")
    assert not set(left) & set(leaks) and set(left) <= set(rows)
    assert len(left) >= len(rows) - len(leaks) - 2  # items of which only a part is left

    out = stages["mixing"](spark, docs, FOLDER).collect()
    words = {r[0]: len(plain.spaced(r[1])) for r in left}
    assert {r.doc_id: r["size"] for r in out} == {d: n for d, n in words.items() if d in {r.doc_id for r in out}}
    assert all(r.taken in (r["size"], 2 * r["size"]) for r in out)


def test_run_is_the_stages_in_turn(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    again = corpus_pipeline.run(spark, FOLDER)
    assert out.columns[:5] == plain.COLUMNS
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))


def test_near_dedup_compares_five_words(spark):
    docs = table(spark, FOLDER, "documents")
    rows = _rows(docs)
    short = [(1000 + i, t, "en", "s", 1) for i, t in enumerate(["one two three", "One two three", "one two four"])]
    docs = docs.select(plain.COLUMNS).union(spark.createDataFrame(short, plain.DOCS))
    sets = sorted((r[0], s) for r in rows + short if (s := plain.shingles(r[1], 5)))
    group = {d: d for d, _ in sets}
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if 100 * len(x & y) >= 80 * len(x | y) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    wanted = sorted(r[0] for r in rows + short if group.get(r[0], r[0]) == r[0])
    out = dict(corpus_pipeline.STAGES)["near dedup"](spark, docs, FOLDER)
    assert sorted(r[0] for r in _rows(out)) == wanted
    assert len(wanted) > sum(k for *_, k in plain.near_dups([r[:2] for r in rows + short]))
