from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tests.llm import plain

from tradelens.llm import packing
from tradelens.llm.tokens import merges, vocabulary_bytes

DOCS = "row string, doc_id bigint, text string, ids string"


@pytest.fixture(scope="module")
def encode():
    known = merges(vocabulary_bytes(None, packing.VOCABULARY))
    return lambda text: known.encode(text or "", add_special_tokens=False).ids + [packing.END]


def _texts():
    rng = random.Random(11)
    words = ["Packing", "ÉTUDE", "é", "don't", "日本語", "x²", "<|endoftext|>", "ΟΔΟΣ", "12", "…", "ﬁ"]
    gaps = [" ", "\n", " ", " ", "\t", "  ", "\r\n", "\x1c", "\x85", "́"]
    made = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 60)))
            for _ in range(120)]
    return made + [None, "", " ", "twice", "twice", "long " * 9000, "a" * 30_000]


def _check(rows, got, encode, length):
    """Every id of every document lies in one piece; sequences have no gaps and no padding."""
    ids = {}
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append(r)
    total = sum(len(encode(t)) for _, t in rows)
    assert sorted(held) == list(range(len(held)))
    sizes = []
    for number in sorted(held):
        at = 0
        for r in sorted(held[number], key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        sizes.append(at)
    assert sizes[:total // length] == [length] * (total // length)
    assert all(n & (n - 1) == 0 for n in sizes[total // length:]) and sum(sizes) == total
    # Equal ids of several documents cannot be told apart: compare the pieces' multiset by document.
    wanted = Counter()
    starts = defaultdict(list)
    for r in got:
        starts[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
    for d, t in rows:
        wanted[d, len(encode(t))] += 1
    for key, some in starts.items():
        lengths = Counter()
        for start, length_, _ in some:
            lengths[start] += 1
            lengths[start + length_] -= 1
        assert lengths[0] == wanted[key] and lengths[key[1]] == -wanted[key]
        assert all(n == 0 for at, n in lengths.items() if 0 < at < key[1])
    assert set(starts) == set(wanted)
    texts = defaultdict(list)
    for d, t in rows:
        ids = np.array(encode(t), "<u4")
        texts[d, len(ids)].append(ids)
    for key, some in starts.items():
        for start, length_, crc in some:
            assert crc in {zlib.crc32(i[start:start + length_].tobytes()) for i in texts[key]}


@pytest.mark.parametrize("length", [64, 4096])
def test_pieces_of_every_document(spark, encode, length):
    rows = [(i if i % 7 else None, t) for i, t in enumerate(_texts())] + [(3, "same"), (3, "same")]
    docs = spark.createDataFrame([("x", *r, "y") for r in rows], DOCS)
    results = []
    for parts in (1, 6):
        got = packing.packed(docs.repartition(parts), length=length).collect()
        _check(rows, got, encode, length)
        results.append(sorted((str(r.doc_id), r.doc_tokens) for r in got if r.start == 0))
    assert results[0] == results[1]


def test_given_documents(spark, encode):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    _check(rows, packing.packed(docs).collect(), encode, packing.LENGTH)


def test_whole_sequences(spark, encode):
    docs = spark.createDataFrame([(i, f"word{i} " * i) for i in range(1, 40)], "doc_id bigint, text string")
    found = packing.sequences(packing.pieces(docs, length=128)).orderBy("sequence_id").collect()
    by_id = defaultdict(list)
    for r in found:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        for part in r.parts:
            by_id[part.doc_id] += ids[part.offset:part.offset + part.length]
    assert by_id == {i: encode(f"word{i} " * i) for i in range(1, 40)}


def test_no_documents(spark):
    assert packing.packed(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_in_single_steps(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    key = packing.hilbert(cells, bits)
    assert sorted(key) == list(range(len(cells)))
    walk = cells[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_projection_by_plain_sums():
    rng = np.random.default_rng(1)
    ids, ptr = rng.integers(0, 5000, 400), np.array([0, 0, 100, 399, 400])
    bucket, signs = packing._buckets(5000), packing._signs()
    found = packing.projected(ids, ptr, bucket, signs)
    for k in range(4):
        held = Counter(bucket[ids[ptr[k]:ptr[k + 1]]].tolist())
        damped = {b: n.bit_length() for b, n in held.items()}
        norm = max(sum(v * v for v in damped.values()), 1) ** .5
        wanted = [sum(v * signs[b, d] for b, v in damped.items()) * packing.ONE / norm for d in range(4)]
        assert np.abs(found[k] - wanted).max() <= 1


def test_neighbours_are_alike(spark):
    rng = random.Random(2)
    subjects = [[f"{a}{b}" for b in "abcdefghij"] for a in ("ship", "corn", "law", "jazz", "star", "salt")]
    docs = [(i, i % 6, " ".join(rng.choices(subjects[i % 6], k=30))) for i in range(600)]
    made = packing.tokenised(spark.createDataFrame(docs, "doc_id bigint, subject int, text string"))
    keys = packing.keyed(made, packing._figures(made)).orderBy("key").collect()
    same = np.mean([a.doc_id % 6 == b.doc_id % 6 for a, b in zip(keys, keys[1:])])
    assert same > 0.6  # by chance one in six


def test_many_pieces_go_to_the_tokenizer_together(encode):
    """One call for a hundred pieces, each with the ids it has alone."""
    from tradelens.llm.tokens import JOINED, Words
    words = Words(vocabulary_bytes(None, packing.VOCABULARY))
    rng = random.Random(12)
    pieces = ["".join(rng.choice("abcéßÿñ") for _ in range(rng.randint(1, 9))) for _ in range(3 * JOINED + 7)]
    pieces += ["!!", "'s", "7", "\0x² y", "%&", "zz", "\0 ", "ÿ"]
    calls = []

    class Counted:
        def encode(self, text, held=words._bare, **more):
            calls.append(text)
            return held.encode(text, **more)

    words._bare = Counted()
    assert words._encode(pieces) == [encode(p.lstrip("\0"))[:-1] for p in pieces]
    assert len(calls) == -(-(len(pieces) - 2) // JOINED)
