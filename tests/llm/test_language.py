from __future__ import annotations

import zlib

import numpy as np
from tests.llm import plain

from tradelens.llm import language

FOLDER = "/root/testdata/sf0.01"


def _hash(piece):
    h = np.zeros(1, np.uint64)
    for c in piece:
        h = language._step(h, np.array([ord(c)]))
    return h[0]


def _vocabulary(pieces):
    return language.Vocabulary(np.sort(np.array([_hash(p) for p in pieces])), max(map(len, pieces)))


def _sum(word, vocabulary, table):
    """All segmentations one by one."""
    if not word:
        return np.ones(table.shape[1])
    total = np.zeros(table.shape[1])
    for n in range(1, len(word) + 1):
        at = np.searchsorted(vocabulary.hashes, _hash(word[:n]))
        if at < len(vocabulary) and vocabulary.hashes[at] == _hash(word[:n]):
            p = table[at]
        elif n == 1:
            p = table[len(vocabulary)]
        else:
            continue
        total = total + p * _sum(word[n:], vocabulary, table)
    return total


def test_forward_sums_all_segmentations():
    vocabulary = _vocabulary(["▁", "a", "b", "ab", "▁a", "ba", "aba", "bb"])
    table = language._table(np.random.default_rng(1).random((len(vocabulary), 3)))
    words = ["▁abab", "▁abbc", "x", "bababa", "▁"]
    found = language.log_probabilities(np.array(words), vocabulary, table)
    for row, word in zip(found, words):
        assert np.allclose(row, np.log(_sum(word, vocabulary, table)))


def test_training_raises_the_likelihood():
    vocabulary = _vocabulary(["▁", "a", "b", "ab", "▁a", "ba"])
    words, languages = np.array(["▁abab", "▁ba", "▁abab"]), np.array([0, 0, 1])
    times = np.array([5.0, 2.0, 1.0])
    likelihoods = []
    for rounds in range(4):
        table = language.train(words, languages, times, 2, vocabulary, rounds)
        each = language.log_probabilities(words, vocabulary, table)
        likelihoods.append(float((each[np.arange(3), languages] * times).sum()))
    assert likelihoods == sorted(likelihoods)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    told = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    found = language.predict(docs).collect()
    assert len(found) == len(told)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == told[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_undetermined_and_odd_rows(spark):
    rows = plain.odd_documents(n=30) + [(500, "12 %% --", "en", "s", 3), (501, "a" * 5000, "en", "s", 3)]
    found = language.predict(spark.createDataFrame(rows, plain.DOCS)).collect()
    assert len(found) == len(rows)
    letterless = sorted(str(r[0]) for r in rows if not any(c.isalpha() for c in r[1] or ""))
    assert sorted(str(r.doc_id) for r in found if r.lang_pred == "und") == letterless
    assert {r.score for r in found if r.lang_pred == "und"} == {0.0}
    unlabelled = spark.createDataFrame([(1, "some text", None, "s", 9)], plain.DOCS)
    assert [r.lang_pred for r in language.predict(unlabelled).collect()] == ["und"]
    assert language.predict(unlabelled.limit(0)).collect() == []


def test_words_are_letters_with_their_marks():
    assert language.words_of("² ½ ① 12 _ 3") == []
    assert language.words_of("हिन्दी x²y") == ["▁हिन्दी", "▁x", "▁y"]
    assert language.words_of("\u0301a e\u0301") == ["▁a", "▁e\u0301"]


def test_texts_without_letters_are_undetermined(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(20)] + [(100, "² ½ 12", None), (101, "१२ ３ ٣", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs).collect()}
    assert got[100] == got[101] == ("und", 0.0) and got[3][0] == "en"
