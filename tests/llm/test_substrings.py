"""Suffix arrays and phrase automata against plain loops."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm import plain

from tradelens.llm import phrases, repeats, suffix

FOLDER = "/root/testdata/sf0.001"


def _rows(df):
    return plain.by_text([tuple(r) for r in df.collect()])


def _texts(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return docs, [tuple(r) for r in docs.collect()]


def test_suffix_dedup_on_documents(spark):
    docs, rows = _texts(spark, FOLDER)
    assert _rows(suffix.deduplicated(docs)) == plain.suffix_dedup(rows)


def test_phrase_dedup_on_documents(spark):
    docs, rows = _texts(spark, FOLDER)
    assert _rows(phrases.deduplicated(docs)) == plain.phrase_dedup(rows)


def test_odd_documents(spark):
    rows = plain.odd_documents()
    docs = spark.createDataFrame(rows, plain.DOCS).repartition(5)
    two = [r[:2] for r in rows]
    assert _rows(suffix.deduplicated(docs)) == plain.suffix_dedup(two)
    assert _rows(phrases.deduplicated(docs)) == plain.phrase_dedup(two)


def test_cut_texts_keep_whole_characters_and_columns(spark):
    rows = plain.odd_documents(seed=8)
    docs = spark.createDataFrame(rows, plain.DOCS)
    extra = docs.selectExpr("*", "1 AS k", "'x' AS tag", "array(1) AS spans", "named_struct('a', 1) AS row")
    out = suffix.without_repeats(extra).collect()
    wanted = plain.without_repeats([r[:2] for r in rows])
    assert extra.schema.names == list(out[0].asDict())
    mine = plain.by_text([(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in out])
    theirs = [(r[0], t, r[2], r[3], None if t is None else len(t)) for r, t in zip(rows, wanted)]
    assert mine == plain.by_text(theirs)


def test_empty_tables(spark):
    none = spark.createDataFrame([], plain.DOCS)
    assert suffix.deduplicated(none).collect() == []
    assert phrases.deduplicated(none).collect() == []
    assert suffix.without_repeats(none).collect() == []


def _pieces(texts):
    return repeats.Pieces(texts, [[(i, 0, 0, len(t))] for i, t in enumerate(texts)], [1] * len(texts))


@pytest.mark.parametrize("array_bytes", [300, 1 << 20])
def test_arrays_are_merged_by_binary_search(array_bytes):
    rng = random.Random(4)
    base = bytes(rng.choice(b"ab\x00\xff") for _ in range(500))
    texts = list({base[a:a + rng.randint(50, 140)] for a in (rng.randrange(350) for _ in range(60))})
    texts = [t for t in texts if len(t) >= 50]
    found = {}
    for key, _, a, b in suffix.kernel(50, array_bytes)(_pieces(texts)):
        found.setdefault(key, set()).update(range(a, b))
    for i, text in enumerate(texts):
        wanted = {p + k for p in range(len(text) - 49) for k in range(50)
                  if any(text[p:p + 50] in other for other in texts[:i])}
        assert found.get(i, set()) == wanted


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=20, max_size=90).map(lambda b: bytes(c % 3 for c in b)),
                min_size=1, max_size=6))
def test_suffix_array_and_common_prefixes(pieces):
    width = 20
    array = suffix._Array(pieces, np.arange(len(pieces)), width)
    at = {}
    for i, text in enumerate(pieces):
        for p in range(len(text) - width + 1):
            at.setdefault(text[p:p + width], []).append(i)
    strings = [s.ljust(width, b"\0") for s in array.strings().tolist()]
    assert strings == sorted(at)
    assert array.least.tolist() == [min(at[s]) for s in strings]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=50))
def test_packed_numbers_come_back(values):
    array = np.array(values, np.uint64)
    assert repeats.unpack(repeats.pack(array)).tolist() == values
    if values:
        assert repeats.unpack_sorted(repeats.pack_sorted(np.sort(array))).tolist() == sorted(values)


def test_runs_hold_every_window_once():
    rng = random.Random(2)
    unit = repeats.Unit(12, 8)
    texts = [bytes(rng.choice(b"abc") for _ in range(rng.choice([0, 5, 11, 12, 13, 200]))) for _ in range(40)]
    runs = repeats.runs(unit, texts)
    anchors: dict[bytes, set[int]] = {}
    windows = []
    for d, a, b, anchor in zip(runs.doc, runs.start, runs.stop, runs.anchor):
        for p in range(a, b - 11):
            windows.append((d, p))
            anchors.setdefault(texts[d][p:p + 12], set()).add(int(anchor))
    assert sorted(windows) == [(d, p) for d, t in enumerate(texts) for p in range(len(t) - 11)]
    assert all(len(a) == 1 for a in anchors.values())


@pytest.mark.parametrize("size", [60, 5000, (1 << 21) + 4000])
def test_suffixes_are_sorted_in_every_size(size, monkeypatch):
    """Numbers hold rank, next rank and place up to 2 MB; only longer texts need places sorted."""
    rng = np.random.default_rng(size)
    text = rng.integers(97, 99, size, np.uint8).tobytes()[:size // 2] * 2
    starts = np.sort(rng.choice(len(text) - 50 + 1, min(len(text) - 49, 4000), replace=False))
    sorts = []
    monkeypatch.setattr(suffix.np, "argsort", lambda *a, f=np.argsort, **k: sorts.append(1) or f(*a, **k))
    order = suffix.suffix_array(text, starts)
    assert order.tolist() == sorted(starts.tolist(), key=lambda s: (text[s:s + 50], s))
    assert bool(sorts) == (size > 1 << 21)


def test_only_recurring_windows_are_sorted(monkeypatch):
    """A piece's windows that no other piece has need no suffix array."""
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 123, 400, np.uint8).tobytes() for _ in range(200)]
    texts[150] = texts[150][:100] + texts[3][200:280] + texts[150][180:]
    sorted_bytes = []
    build = suffix._Array.__init__
    monkeypatch.setattr(suffix._Array, "__init__",
                        lambda self, pieces, *a: sorted_bytes.append(sum(map(len, pieces))) or build(self, pieces, *a))
    found = [tuple(row) for row in suffix.kernel(50)(_pieces(texts))]
    assert found == [(150, 0, 100, 180)]
    assert sum(sorted_bytes) == 2 * 80


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=20, max_size=90).map(lambda b: bytes(c % 3 for c in b)),
                min_size=1, max_size=6))
def test_every_repeated_window_recurs(pieces):
    width = 20
    places = {}
    for i, text in enumerate(pieces):
        for p in range(len(text) - width + 1):
            places.setdefault(text[p:p + width], []).append((i, p))
    of, start, stop = suffix.recurring(pieces, width)
    found = [(i, p) for i, a, b in zip(of, start, stop) for p in range(a, b - width + 1)]
    assert sorted(found) == sorted(p for each in places.values() if len(each) > 1 for p in each)


@pytest.mark.parametrize("width", [8, 20, 33, 50])
def test_equal_bytes_have_equal_hashes_wherever_they_start(width):
    rng = np.random.default_rng(width)
    same = rng.integers(0, 256, 60, np.uint8).tobytes()
    stretch = repeats._STRETCH
    at = [0, 700, stretch - 30, 2 * stretch - 1, 3 * stretch, 3 * stretch + 5000]
    text = bytearray(rng.integers(0, 256, at[-1] + width, np.uint8).tobytes())
    for place in at:
        text[place:place + width] = same[:width]
    hashes = repeats.byte_hashes(bytes(text), width)
    assert len(hashes) == len(text)
    assert len(set(hashes[at].tolist())) == 1
    assert len(set(hashes.tolist())) == len(text) - len(at) + 1


def test_spans_of_a_batch_are_merged_text_by_text():
    span = pa.list_(pa.struct([("tag", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]))
    rows = [[(1, 0, 9)], None, [(1, 30, 60), (2, 0, 99), (1, 0, 10), (1, 10, 20), (1, 40, 50)], [],
            [(7, 0, 5)], [(1, 5, 6), (1, 1, 2)]]
    named = [r and [dict(zip(("tag", "start", "stop"), s)) for s in r] for r in rows]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1] * 6, pa.int32()), pa.array(named, span)], ["tag", "spans"])
    wanted = [[(0, 9)], [], [(0, 20), (30, 60)], [], [], [(1, 2), (5, 6)]]
    assert repeats.merged(batch) == wanted
    assert repeats.merged(batch.slice(2)) == wanted[2:]
    assert repeats.merged(batch.slice(1, 1)) == [[]]


@pytest.mark.parametrize("same_document", [False, True])
def test_equal_pieces_of_a_slice_are_settled_there(same_document):
    unit = repeats.Unit(5, 3, same_document=same_document)
    pieces = [b"a", b"b", b"a", b"c", b"b", b"a"]
    sent, full, weight, known = repeats._settle(unit, pieces, np.array([4, 2, 9, 1, 2, 4]), np.arange(6))
    if same_document:
        assert (sent.tolist(), full.tolist(), weight.tolist()) == ([0, 1, 3], [True] * 3, [2, 2, 1])
        assert known.tolist() == [0, 1, 2, 4, 5]
    else:
        assert sent.tolist() == [0, 5, 1, 4, 3]
        assert full.tolist() == [True, False, True, False, True]
        assert (weight.tolist(), known.tolist()) == ([1] * 5, [2])
