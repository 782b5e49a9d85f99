from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm import plain

from tradelens.llm import quality

FOLDER = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int"


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab #|\né\t \x1c", max_size=60))
def test_base_counts(text):
    assert quality.base_counts(text.encode()) == plain.base(text)


def _grams(text):
    data = (text or "").encode()
    return quality.gram_buckets(data)[:max(len(data) - 3, 0)].tolist()


def _scores(rows, labels):
    """Each text's mean log-likelihood ratio by plain counting."""
    good = {d for d in {x[0] for x in labels} if d is not None
            and all(q == 1 and t == 0 for i, q, t in labels if i == d)}
    raw, target = Counter(), Counter()
    for d, t in rows:
        raw.update(_grams(t))
        if d in good:
            target.update(_grams(t))
    share = sum(target.values()) / sum(raw.values())
    a = quality.SMOOTHING * sum(target.values())
    ratio = {g: math.log((target[g] + a) / (raw[g] * share + a)) for g in raw}
    return [round(sum(ratio[g] for g in _grams(t)) / max(len(_grams(t)), 1), 9) for _, t in rows]


def test_scores_and_counts_by_plain_loops(spark):
    rows = plain.odd_documents(n=40)
    docs = spark.createDataFrame(rows, plain.DOCS).repartition(3)
    labels = [(i, 1, 0) for i in range(0, 40, 3)] + [(9, 0, 0), (12, 1, None), (None, 1, 0)]
    told = spark.createDataFrame(labels, LABELS)
    out = quality.judge(docs, told).collect()
    two = [r[:2] for r in rows]
    assert len(out) == len(rows)
    wanted = plain.by_text([(d, *plain.base(t), score) for (d, t), score in zip(two, _scores(two, labels))])
    assert plain.by_text([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                           r.n_repeat_words, round(r.score, 9)) for r in out]) == wanted
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.score >= quality.LEAST_SCORE and r.worst_word == 0)


def _worst(rows, labels, least):
    """Each text's most negative word ratio below ``least``, from counted documents."""
    good = {d for d in {x[0] for x in labels} if d is not None
            and all(q == 1 and t == 0 for i, q, t in labels if i == d)}
    held = [(d, set(re.findall(rb"[a-z\x80-\xff]+", (t or "").encode().lower()))) for d, t in rows]
    raw, target = Counter(), Counter()
    for d, words in held:
        raw.update(words)
        if d in good:
            target.update(words)
    n = sum(d in good for d, _ in held)
    a = quality.WORD_SMOOTHING * n
    ratio = {w: math.log((target[w] + a) / (raw[w] * n / len(held) + a)) for w in raw}
    return [(d, round(min([ratio[w] for w in words if ratio[w] < least], default=0.0), 9)) for d, words in held]


@pytest.mark.parametrize("least", [-3.0, -0.3])
def test_worst_words_by_plain_counting(spark, least):
    rows = [r[:2] for r in plain.odd_documents(n=40)]
    labels = [(i, 1, 0) for i in range(0, 40, 3)] + [(9, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = quality.ratios(docs, spark.createDataFrame(labels, LABELS), least=least)
    got = quality.judged(docs, found).collect()
    assert plain.by_text([(r.doc_id, round(r.worst_word, 9)) for r in got]) \
        == plain.by_text(_worst(rows, labels, least))


def test_a_verdict_does_not_depend_on_the_batch(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    found = quality.ratios(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    whole, dealt = (sorted(map(tuple, quality.judged(d, found).collect()))
                    for d in (docs.coalesce(1), docs.repartition(37)))
    assert whole == dealt


def test_documents_with_abusive_words_go(spark):
    """Words that one document in thirty has, and none of the target: in any place, in any case."""
    rng = random.Random(3)
    words = [f"word{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    docs, labels = [], []
    for i in range(1500):
        text = rng.choices(words, k=300)
        if i % 15 == 7:
            text[rng.randrange(300)] = rng.choice(["Vile", "vile,", "foul!"])
        docs.append((i, " ".join(text)))
        if i % 2 == 0:
            labels.append((i, 1, int(i % 15 == 7)))
    out = quality.judge(spark.createDataFrame(docs, "doc_id bigint, text string"),
                        spark.createDataFrame(labels, LABELS)).collect()
    assert {r.doc_id for r in out if not r.kept} == {i for i in range(1500) if i % 15 == 7}


def test_good_documents_stay_and_junk_goes(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = quality.judge(docs, labels).join(labels, "doc_id").where(~F.col("base_failed"))
    rates = {(r.quality, r.toxic): r.kept for r in out.groupBy("quality", "toxic").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rates[1, 0] > 0.999 and rates[0, 0] < 0.02
    # Labels call documents toxic that have none of the words: of those with one, all go.
    abusive = out.where("quality = 1 AND toxic = 1").join(docs.select("doc_id", "text"), "doc_id") \
        .where(F.lower("text").rlike(r"\b(idiot|moron|scum|stupid)\b"))
    assert abusive.count() > 150 and abusive.where("kept").count() == 0
    assert rates[1, 1] < 0.45


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame(plain.odd_documents(n=20), plain.DOCS)
    labels = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality.judge(docs, labels).collect()} == {0.0}
    assert quality.judge(docs.limit(0), labels).collect() == []


@pytest.mark.parametrize("extra", ["score", "kept", "row", "bucket"])
def test_kept_carries_columns(spark, extra):
    docs = spark.createDataFrame(plain.odd_documents(n=20), plain.DOCS).withColumn(extra, F.lit(3))
    out = quality.kept(docs, spark.createDataFrame([], LABELS))
    assert out.columns == docs.columns
    assert {r[extra] for r in out.collect()} == {3}
