from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from tests.llm import plain

from tradelens.llm import alignment, sparse
from tradelens.llm.alignment import A_VOCABULARY, B_VOCABULARY, Side
from tradelens.llm.tokens import vocabulary_bytes


@pytest.fixture(scope="module")
def encoders():
    """Both tokenizers on whole texts, and the bytes of each id."""
    a, b = (maker(vocabulary_bytes(None, name)) for maker, name in
            ((Side.byte_level, A_VOCABULARY), (Side.pieces, B_VOCABULARY)))
    import sentencepiece
    from tokenizers import Tokenizer
    whole_a = Tokenizer.from_buffer(vocabulary_bytes(None, A_VOCABULARY))
    whole_a.encode_special_tokens = True
    whole_b = sentencepiece.SentencePieceProcessor(model_proto=vocabulary_bytes(None, B_VOCABULARY))
    return (lambda t: whole_a.encode(" " + t, add_special_tokens=False).ids, a.of_id,
            lambda t: whole_b.encode(t), b.of_id)


def _document(text, encoders):
    """a ids, b ids, their groups, overlaps, by walking the bytes of the whole text."""
    encode_a, bytes_a, encode_b, bytes_b = encoders
    a, b = (encode_a(text), encode_b(text)) if text else ([], [])
    wanted = (" " + (text or "")).encode()
    if any(b"".join(of[i] for i in ids) != wanted for ids, of in ((a, bytes_a), (b, bytes_b))):
        return [], [], [], [], []

    def ranges(ids, of):
        out, at = [], 0
        for i in ids:
            out.append((at, at + len(of[i])))
            at += len(of[i])
        return out
    ra, rb = ranges(a, bytes_a), ranges(b, bytes_b)
    both = sorted({y for _, y in ra} & {y for _, y in rb})
    ga = [sum(e <= x for e in both) for x, _ in ra]
    gb = [sum(e <= x for e in both) for x, _ in rb]
    overlaps = [(i, j, min(y, v) - max(x, u)) for i, (x, y) in enumerate(ra)
                for j, (u, v) in enumerate(rb) if min(y, v) > max(x, u)]
    return a, b, ga, gb, overlaps


def _by_plain(rows, encoders):
    documents = [(d, *_document(t, encoders)) for d, t in rows]
    held, links = Counter(), []
    for _, a, b, ga, gb, _ in documents:
        mine = [(x, y) for x, g in zip(a, ga) for y, h in zip(b, gb) if g == h]
        links.append(mine)
        held.update(set(mine))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for (d, a, b, ga, gb, _), mine in zip(documents, links):
        groups = sorted(set(ga))
        text = ";".join(",".join(str(x) for x, h in zip(a, ga) if h == g) + "|"
                        + ",".join(str(y) for y, h in zip(b, gb) if h == g) for g in groups)
        out.append((d, len(a), len(b), len(groups), len(mine),
                    sum(held[p] == most[p[0]] for p in mine), sum(held[p] for p in mine),
                    hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return plain.by_text(out)


def _texts():
    rng = random.Random(5)
    words = ["alignment", "tokenizers", "étude", "naïve", "日本語", "🙂🙂", "don't", "x²", "<s>",
             "<|endoftext|>", "1234567", "…", "ß", "a" * 40, "unbelievably"]
    gaps = [" ", "  ", "\n", " \n", "\t ", " ", "  ", "  ", "\r\n", "\x1c ", "   "]
    made = ["".join(rng.choice(words) + rng.choice(gaps if rng.random() < .3 else [" "])
                    for _ in range(rng.randint(1, 40))) for _ in range(60)]
    return made + [None, "", " ", "  ", "\n", " a", "a ", "▁", "one ▁ two", "a\x00b", "﻿x", "<0x0A>",
                   "same text here", "same text here", "z" * 3000, "日" * 300]


def test_documents_by_walking_bytes(spark, encoders):
    rows = [(i if i % 9 else None, t) for i, t in enumerate(_texts())] + [(1, "same id"), (1, "same id")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, slice string, pair int")
    for parts in (1, 7):
        got = alignment.aligned(docs.repartition(parts)).collect()
        assert plain.by_text([tuple(r) for r in got]) == _by_plain(rows, encoders)
    found = alignment.document_links(docs).collect()
    mine = [(r.doc_id, r.a_ids, r.b_ids, r.a_groups, r.b_groups, [tuple(o) for o in r.overlaps])
            for r in found]
    assert plain.by_text(mine) == plain.by_text([(d, *_document(t, encoders)) for d, t in rows])


def test_given_documents(spark, encoders):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(d, t) for d, t in docs.collect() if len(t or "") < 1000]
    got = alignment.aligned(spark.createDataFrame(rows, docs.schema).repartition(5)).collect()
    assert plain.by_text([tuple(r) for r in got]) == _by_plain(rows, encoders)


def test_bytes_that_are_no_text(spark):
    docs = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text UNION ALL SELECT 2L, 'ab'")
    got = {r.doc_id: (r.n_a, r.groups_sha256) for r in alignment.aligned(docs).collect()}
    assert got[1] == (0, "") and got[2][0] > 0


def test_long_text_without_spaces_and_no_rows(spark):
    text = "ab" * 200_000 + " " + "word " * 100_000
    docs = spark.createDataFrame([(1, text), (2, "word")], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in alignment.aligned(docs).collect()}
    assert rows[1].n_links >= rows[1].n_a - rows[1].n_groups and rows[2].n_groups == 1
    assert alignment.aligned(docs.where("doc_id > 5")).collect() == []


def test_products_of_sparse_matrices(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(sparse, "BLOCK", 7)
    for _ in range(40):
        m, n, k = rng.integers(1, 9, 3)
        a, b = (rng.integers(0, 3, s) * rng.integers(0, 2, s) for s in ((m, n), (n, k)))
        x, y = (sparse.CSR.of(*np.nonzero(d), d.shape, d[np.nonzero(d)]) for d in (a, b))

        def dense(c):
            out = np.zeros((c.height, c.width), int)
            out[c.rows(), c.col] = c.val
            return out
        assert (dense(x @ y) == a @ b).all()
        assert (dense(x.transposed()) == a.T).all()
        assert (x.times(np.arange(n)) == a @ np.arange(n)).all()


def test_matrices_come_back_from_their_steps():
    rng = np.random.default_rng(3)
    for height, width, count in ((0, 0, 0), (3, 5, 0), (1, 1, 1), (7, 300, 60), (50, 4, 90)):
        made = sparse.CSR.of(rng.integers(0, max(height, 1), count), rng.integers(0, max(width, 1), count),
                             (height, width))
        steps = alignment._unpacked(alignment._packed(alignment._steps(made)))
        found = alignment._stepped(*steps, width)
        assert all((x == y).all() for x, y in zip(made[:3], found[:3])) and found.width == width


def test_columns_take_little_room_as_steps():
    """A slice's matrices are the largest rows that are shuffled."""
    rng = np.random.default_rng(4)
    matrix = sparse.CSR.of(np.repeat(np.arange(200), 300), rng.integers(0, 30_000, 60_000), (200, 30_000))
    plain_ = alignment._packed([matrix.ptr, matrix.col, matrix.val])
    assert len(alignment._packed(alignment._steps(matrix))) < 0.75 * len(plain_)


def test_a_worker_lets_go_of_what_it_holds():
    from tradelens.llm import tokens
    first = tokens.per_worker("test", [b"file"], lambda: object())
    assert tokens.per_worker("test", [b"file"], lambda: object()) is first
    tokens.forget_worker()
    assert tokens.per_worker("test", [b"file"], lambda: object()) is not first
    tokens.forget_worker()
