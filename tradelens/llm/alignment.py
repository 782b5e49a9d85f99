"""Cross-tokenizer alignment by products of token-byte incidence matrices.

A text is encoded by two tokenizers, A and B. The matrix of A has a row for every token and a column
for every byte, so has that of B; A times B transposed, row by row as Gustavson does, links the
tokens that overlap. The links in order make a staircase: where it advances on both sides at once,
an A token and a B token end at the same byte, and a new group begins. The incidence of A ids and
groups times that of groups and B ids counts the links of tokens that share a group.

Neither tokenizer joins bytes across a space that follows something else than white space, so texts
are cut there and every distinct piece of a slice of documents is encoded and multiplied once;
documents times pieces times id pairs are two more matrices. A document with a piece that does not
come back byte for byte is encoded again as a whole.

How many documents hold a pair is added up over all slices, each of which sends a pair once. The
counts go back to the slices, where they meet the matrices, which were written for this.

Defined cases: a null or empty text, or one whose tokens of A or of B do not join to a space and the
text, has no tokens and zeros throughout. Every row is a document of its own, also if its doc_id is
null or repeated. A text longer than a slice stands alone in one; the work and memory are
proportional to its tokens and links. Two tokens that share a group of p A tokens and q B tokens are
one of p * q links; these are counted by distinct ids and never listed. An empty table gives an
empty result. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm.sparse import CSR
from tradelens.llm.text import bounded_batches, slices, texts
from tradelens.llm.tokens import (
    KEPT, KEPT_CHARS, byte_characters, forget_worker, looked_up, merges, per_worker, spread,
    vocabulary_bytes,
)
from tradelens.session import materialise

A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE = "▁"  # what B writes for a space
CUT = re.compile(r"(?<=\S)(?= )")
PLAIN = re.compile("[\x00-\u024f]{1,256}")
BEFORE_SPACE = re.compile(r"\s ")


def _in_merge_order(entries: dict[str, int], pairs: list) -> bool:
    """Whether the longer entries are numbered as their merges are ordered."""
    made = [entries["".join(p if isinstance(p, list) else p.split(" "))] for p in pairs]
    return all(x < y for x, y in zip(made, made[1:])) and \
        len(made) == sum(len(e) > 1 for e in entries)


class Side:
    """One tokenizer: each id's bytes, and the ids of pieces."""

    def __init__(self, of_id: list[bytes], encode):
        self.of_id, self.size = of_id, np.array([len(b) for b in of_id], np.int64)
        self.encode = encode

    @classmethod
    def byte_level(cls, data: bytes) -> Side:
        """``data`` is a tokenizers file with byte-level entries; it is given the space itself.

        Where the entries are numbered in the order of their merges, the same merges run in the
        faster tiktoken: for short pieces of the letters of which all versions of Unicode agree.
        """
        known, byte = merges(data), byte_characters()
        of_id = [b""] * known.get_vocab_size(with_added_tokens=True)
        entries = known.get_vocab(with_added_tokens=False)
        for entry, i in entries.items():
            of_id[i] = bytes(byte[c] for c in entry)

        def whole(pieces: list[str]) -> list[list[int]]:
            return [e.ids for e in known.encode_batch_fast(pieces, add_special_tokens=False)]

        if not _in_merge_order(entries, json.loads(data)["model"]["merges"]):
            return cls(of_id, whole)
        from public_tokenizers import PATTERN
        from tiktoken import Encoding
        ranks = {of_id[i]: i for i in entries.values()}
        fast = Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

        def encode(pieces: list[str]) -> list[list[int]]:
            return [fast.encode_ordinary(p) if PLAIN.fullmatch(p) else whole([p])[0] for p in pieces]
        return cls(of_id, encode)

    @classmethod
    def pieces(cls, data: bytes) -> Side:
        """``data`` is a sentencepiece model that puts a space before what it is given."""
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        count = model.get_piece_size()
        of_id = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
                 else model.id_to_piece(i).replace(SPACE, " ").encode() for i in range(count)]
        alone = [model.piece_to_id(SPACE)]

        def encode(pieces: list[str]) -> list[list[int]]:
            found = model.encode([p[1:] for p in pieces], num_threads=1)
            return [ids if p != " " else alone for p, ids in zip(pieces, found)]
        return cls(of_id, encode)

    def joined(self, ids) -> bytes:
        return b"".join(map(self.of_id.__getitem__, ids))


def _tokens(side: Side, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the pieces in a row, where each one's start and end, and whether they join to it."""
    found = side.encode(pieces)
    sizes = [len(i) for i in found]
    flat = np.fromiter(chain.from_iterable(found), np.int64, sum(sizes))
    if side.joined(flat.tolist()) == "".join(pieces).encode():
        restored = np.ones(len(pieces), bool)
    else:
        restored = np.array([side.joined(i) == p.encode() for i, p in zip(found, pieces)], bool)
    return flat, np.append(0, np.cumsum(sizes)), restored


class Aligned(NamedTuple):
    """What the tokens of some pieces have to do with each other; ``ptr`` cut tokens by piece."""

    a: np.ndarray
    a_ptr: np.ndarray
    b: np.ndarray
    b_ptr: np.ndarray
    overlap: CSR  # A tokens x B tokens: bytes they share
    a_group: np.ndarray
    b_group: np.ndarray


def align(a: Side, b: Side, ids_a, ids_b) -> Aligned:
    """Overlaps and groups of pieces whose tokens join to the same bytes on both sides."""
    (a_ids, a_ptr), (b_ids, b_ptr) = ids_a, ids_b
    ends = np.append(0, np.cumsum(a.size[a_ids]))
    count = int(ends[-1])
    rows_a = CSR(ends, np.arange(count), np.ones(count, np.int64), count)
    byte_of = np.repeat(np.arange(len(b_ids)), b.size[b_ids])
    b_transposed = CSR(np.arange(count + 1), byte_of, np.ones(count, np.int64), len(b_ids))
    overlap = rows_a @ b_transposed
    row, col = overlap.rows(), overlap.col
    fresh = np.append(True, (row[1:] != row[:-1]) & (col[1:] != col[:-1]))[:len(row)]
    group = np.cumsum(fresh) - 1
    b_group = np.empty(len(b_ids), np.int64)
    b_group[col] = group
    return Aligned(a_ids, a_ptr, b_ids, b_ptr, overlap, group[overlap.ptr[:-1]], b_group)


def _groups(found: Aligned) -> int:
    return int(found.a_group[-1]) + 1 if len(found.a_group) else 0


def shared(found: Aligned, size_a: int, size_b: int) -> tuple[CSR, np.ndarray]:
    """Pieces x distinct id pairs: links of tokens that share a group; and the pairs.

    A pair is the A id times 2^32 plus the B id.
    """
    piece = np.repeat(np.arange(len(found.a_ptr) - 1), np.diff(found.a_ptr))
    holders, holder = np.unique(piece * size_a + found.a, return_inverse=True)
    groups = _groups(found)
    by_a = CSR.of(holder, found.a_group, (len(holders), groups))
    by_b = CSR.of(found.b_group, found.b, (groups, size_b))
    links = by_a @ by_b
    of = holders[links.rows()]
    pairs, pair = np.unique((of % size_a << 32) + links.col, return_inverse=True)
    return CSR.of(of // size_a, pair, (len(found.a_ptr) - 1, len(pairs)), links.val), pairs


class Writing:
    """Groups as text: A ids, a bar, B ids; groups by semicolons, ids by commas."""

    def __init__(self, size_a: int, size_b: int):
        self.size_a, self.size_b = size_a, size_b
        self.text = [f"{i}{mark}" for mark, size in ((",", size_a), ("|", size_a), (",", size_b),
                                                     (";", size_b)) for i in range(size)]
        self.length = np.array([len(t) for t in self.text], np.int64)

    def of(self, found: Aligned) -> list[str]:
        """The groups of each piece."""
        last_a = np.append(found.a_group[1:] != found.a_group[:-1], True)[:len(found.a)]
        last_b = np.append(found.b_group[1:] != found.b_group[:-1], True)[:len(found.b)]
        groups = _groups(found)
        n_a = np.bincount(found.a_group, minlength=groups)
        n_b = np.bincount(found.b_group, minlength=groups)
        code = np.empty(len(found.a) + len(found.b), np.int64)
        before = np.cumsum(n_b) - n_b
        code[np.arange(len(found.a)) + before[found.a_group]] = found.a + last_a * self.size_a
        code[np.arange(len(found.b)) + np.cumsum(n_a)[found.b_group]] = \
            found.b + 2 * self.size_a + last_b * self.size_b
        whole = "".join(map(self.text.__getitem__, code.tolist()))
        ends = np.append(0, np.cumsum(self.length[code]))[found.a_ptr + found.b_ptr].tolist()
        return [whole[x:y - 1] for x, y in zip(ends, ends[1:])]


def cut(text: str) -> list[str]:
    """A space and the text, cut where neither tokenizer joins bytes."""
    text = " " + text
    if BEFORE_SPACE.search(text):
        return CUT.split(text)
    return [" " + part for part in text.split(" ")[1:]]


class Known:
    """What is known of distinct pieces: figures, groups as text, linked id pairs.

    Bounded: beyond ``KEPT`` pieces or ``KEPT_CHARS`` characters all is forgotten before a new slice.
    """

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        self.writing = Writing(len(a.of_id), len(b.of_id))
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.text: list[str] = []
        self.chars = 0
        self.restored = np.empty(0, bool)
        self.figures = np.empty((0, len(FIGURES)), np.int64)
        self.ptr = np.zeros(1, np.int64)
        self.pair, self.links = np.empty(0, np.int64), np.empty(0, np.int64)

    def numbers(self, pieces: list[str]) -> np.ndarray:
        return looked_up(self.number, pieces, self._learn)

    def _learn(self, new: list[str]) -> None:
        sides = [_tokens(side, new) for side in (self.a, self.b)]
        good = sides[0][2] & sides[1][2]
        kept = np.flatnonzero(good)
        found = align(self.a, self.b, *(spread(flat, ptr, kept) for flat, ptr, _ in sides))
        links, pairs = shared(found, len(self.a.of_id), len(self.b.of_id))
        piece = np.repeat(np.arange(len(kept)), np.diff(found.a_ptr))
        first = np.append(True, found.a_group[1:] != found.a_group[:-1])[:len(found.a)]
        figures = np.zeros((len(new), len(FIGURES)), np.int64)
        figures[kept] = np.stack([
            np.diff(found.a_ptr), np.diff(found.b_ptr),
            np.bincount(piece[first], minlength=len(kept)),
            links.times(np.ones(links.width, np.int64))], axis=1)
        held = np.zeros(len(new), np.int64)
        held[kept] = np.diff(links.ptr)
        text = dict(zip(kept.tolist(), self.writing.of(found)))
        self.text += [text.get(i, "") for i in range(len(new))]
        self.restored = np.append(self.restored, good)
        self.figures = np.concatenate([self.figures, figures])
        self.ptr = np.append(self.ptr, self.ptr[-1] + np.cumsum(held))
        self.pair = np.append(self.pair, pairs[links.col])
        self.links = np.append(self.links, links.val)
        self.chars += sum(map(len, new))
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))

    def documents(self, raw: list[bytes]) -> list[np.ndarray]:
        """The numbers of each document's pieces; none if it has no tokens."""
        if len(self.number) > KEPT or self.chars > KEPT_CHARS:
            self.forget()
        held = [data.decode("utf-8", "replace") for data in raw]
        parts = [cut(text) if text and text.encode() == data else []
                 for text, data in zip(held, raw)]
        ends = np.cumsum([len(some) for some in parts])
        numbers = np.split(self.numbers(list(chain.from_iterable(parts))), ends)[:len(raw)]
        for i, mine in enumerate(numbers):
            if not self.restored[mine].all():
                mine = self.numbers([" " + held[i]])
                numbers[i] = mine[self.restored[mine]]
        return numbers


FIGURES = ["n_a", "n_b", "n_groups", "n_links"]
SCHEMA = ("doc_id array<bigint>, groups_sha256 array<string>, matrices binary, pairs array<bigint>, "
          "docs array<int>, " + ", ".join(f"{n} array<bigint>" for n in FIGURES))


def _packed(arrays: list[np.ndarray]) -> bytes:
    """Arrays of non-negative integers, each in the narrowest type, compressed."""
    import zstandard
    out = []
    for array in arrays:
        kind = np.min_scalar_type(int(array.max(initial=0)))
        out.append(np.array([len(array), kind.itemsize], "<u8").tobytes() + array.astype(kind).tobytes())
    return zstandard.compress(b"".join(out), 1)


def _unpacked(data: bytes) -> list[np.ndarray]:
    import zstandard
    data, at, out = zstandard.decompress(data), 0, []
    while at < len(data):
        count, size = np.frombuffer(data, "<u8", 2, at).tolist()
        out.append(np.frombuffer(data, f"<u{size}", count, at + 16).astype(np.int64))
        at += 16 + count * size
    return out


def _steps(matrix: CSR) -> list[np.ndarray]:
    """Entries of each row, columns as steps from the one before in the row, values: small numbers."""
    size, step = np.diff(matrix.ptr), np.diff(matrix.col, prepend=0)
    first = matrix.ptr[:-1][size > 0]
    step[first] = matrix.col[first]
    return [size, step, matrix.val]


def _stepped(size: np.ndarray, step: np.ndarray, val: np.ndarray, width: int) -> CSR:
    """The matrix whose ``_steps`` these are."""
    ptr = np.append(0, np.cumsum(size))
    upto = np.append(0, np.cumsum(step))
    return CSR(ptr, upto[1:] - np.repeat(upto[ptr[:-1]], size), val, width)


def _summary(known: Known, raw: list[bytes]) -> dict:
    """The matrices and figures of a slice."""
    numbers = known.documents(raw)
    every, piece = np.unique(np.concatenate(numbers), return_inverse=True)
    doc = np.repeat(np.arange(len(raw)), [len(n) for n in numbers])
    docs = CSR.of(doc, piece, (len(raw), len(every)))
    pair, ptr = spread(known.pair, known.ptr, every)
    pairs, col = np.unique(pair, return_inverse=True)
    links = CSR(ptr, col, spread(known.links, known.ptr, every)[0], len(pairs))
    digests = [hashlib.sha256(";".join(map(known.text.__getitem__, n.tolist())).encode()).hexdigest()
               if len(n) else "" for n in numbers]
    return {
        "groups_sha256": digests, "pairs": pairs,
        "docs": np.bincount((docs @ links).col, minlength=len(pairs)),
        "matrices": _packed([*_steps(docs), *_steps(links)]),
    } | {name: docs.times(known.figures[every, k]) for k, name in enumerate(FIGURES)}


def _known_pieces(docs: DataFrame, a_path: str | None, b_path: str | None):
    """A function that gives a task what its worker knows of pieces; the files travel as broadcasts."""
    files = [docs.sparkSession.sparkContext.broadcast(vocabulary_bytes(path, name))
             for path, name in ((a_path, A_VOCABULARY), (b_path, B_VOCABULARY))]
    def make() -> Known:
        return Known(Side.byte_level(files[0].value), Side.pieces(files[1].value))
    return lambda: per_worker("pieces", [file.value for file in files], make)


def sliced(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row for each slice of documents, with its matrices; written."""
    bounded_batches(docs.sparkSession)
    known_pieces = _known_pieces(docs, a_path, b_path)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_pieces()
        kinds = {"groups_sha256": pa.string(), "docs": pa.int32()}
        for batch in slices(batches):
            found = _summary(known, texts(batch).to_pylist())
            columns = {"doc_id": batch.column(0)} | {
                name: pa.array(values, kinds.get(name, pa.int64()))
                for name, values in found.items() if name != "matrices"}
            rows = {n: pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c)
                    for n, c in columns.items()} | {"matrices": pa.array([found["matrices"]], pa.binary())}
            order = [f.split()[0] for f in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([rows[n] for n in order], order)

    return materialise(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(encode, SCHEMA)
                       .select(F.monotonically_increasing_id().alias("slice"), "*"))


def pair_counts(slices_: DataFrame) -> DataFrame:
    """pair, docs, best: documents that hold an id pair linked; 1 if its A id has none with more.

    The most a pair of an A id has is a row for each id of A's vocabulary, so it may be broadcast.
    """
    counts = slices_.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")) \
        .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("docs"))
    counts = materialise(counts.withColumn("a", F.shiftright("pair", 32)))
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(F.broadcast(most), "a").select(
        "pair", "docs", (F.col("docs") == F.col("most")).cast("int").alias("best"))


def aligned(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every document."""
    made = sliced(docs, a_path, b_path)
    counts = pair_counts(made)
    wanted = made.select(F.col("slice").alias("of"), F.posexplode("pairs").alias("at", "pair")) \
        .join(counts, "pair").select("of", "at", "docs", "best")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        """A slice's matrices times the counts of its pairs."""
        forget_worker()  # what is known of pieces would only take memory here
        row = {n: left.column(n).combine_chunks().flatten() for n in ("doc_id", "groups_sha256", *FIGURES)}
        held = _unpacked(left.column("matrices")[0].as_py())
        count, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        at = right.column("at").to_numpy()
        count[at] = right.column("docs").to_numpy()
        best[at] = right.column("best").to_numpy()
        of_docs = _stepped(*held[:3], len(held[3]))
        links = _stepped(*held[3:], right.num_rows)
        figures = {"n_best": of_docs.times(links.times(best)),
                   "count_sum": of_docs.times(links.times(count))}
        return pa.table({"doc_id": row["doc_id"]} | {n: row[n] for n in FIGURES}
                        | {n: pa.array(v, pa.int64()) for n, v in figures.items()}
                        | {"groups_sha256": row["groups_sha256"]})

    matrices = made.drop("pairs", "docs")
    figures = [*FIGURES, "n_best", "count_sum"]
    schema = "doc_id bigint, " + ", ".join(f"{n} bigint" for n in figures) + ", groups_sha256 string"
    return matrices.groupBy("slice").cogroup(wanted.groupBy("of")).applyInArrow(finish, schema)


def document_links(docs: DataFrame, a_path: str | None = None, b_path: str | None = None
                   ) -> DataFrame:
    """Tokens and links of every document, for those who want them whole.

    doc_id; a_ids, b_ids; a_groups, b_groups: each token's group, from 0; overlaps: A token, B token
    (from 0) and the bytes they share. Arrays are empty where a document has no tokens.
    """
    bounded_batches(docs.sparkSession)
    known_pieces = _known_pieces(docs, a_path, b_path)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_pieces()
        for batch in slices(batches):
            rows = []
            numbers = known.documents(texts(batch).to_pylist())
            names = list(known.number)
            for doc, mine in zip(batch.column(0).to_pylist(), numbers):
                pieces = [names[p] for p in mine.tolist()]
                one = align(known.a, known.b, *(_tokens(side, pieces)[:2] for side in (known.a, known.b)))
                rows.append({
                    "doc_id": doc, "a_ids": one.a.tolist(), "b_ids": one.b.tolist(),
                    "a_groups": one.a_group.tolist(), "b_groups": one.b_group.tolist(),
                    "overlaps": [{"a": x, "b": y, "bytes": n} for x, y, n in zip(
                        one.overlap.rows().tolist(), one.overlap.col.tolist(),
                        one.overlap.val.tolist())]})
            yield pa.RecordBatch.from_pylist(rows, schema=shape)

    ints = pa.list_(pa.int32())
    link = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("bytes", pa.int32())])
    shape = pa.schema([("doc_id", pa.int64()), ("a_ids", ints), ("b_ids", ints), ("a_groups", ints),
                       ("b_groups", ints), ("overlaps", pa.list_(link))])
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        encode, "doc_id bigint, a_ids array<int>, b_ids array<int>, a_groups array<int>, "
                "b_groups array<int>, overlaps array<struct<a: int, b: int, bytes: int>>")
