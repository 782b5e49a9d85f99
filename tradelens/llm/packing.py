"""Packing documents into sequences along a space-filling curve.

A document is the ids of its text and an end id. Its ids are counted in hashed buckets, the counts
are damped and brought to length one, and projected to a few dimensions by fixed random signs. Each
dimension is centred and scaled by the corpus, squeezed to a grid, and the cell's place on a Hilbert
curve is the document's key. Documents are range-sorted by (key, doc_id, row), the ranges' sizes
give every document's place in one long row of ids, and that row is cut every ``LENGTH`` ids: a
sequence holds neighbours of the curve. What is left at the end is cut into powers of two, so that
no sequence has padding.

Texts are tokenised once, by words: the tokenizer drops white space and joins nothing across it. The
ids are written, only (row, doc_id, key, size) is sorted, and the ids are shuffled once, to their
place. All sums are integers, so a rerun packs alike.

Defined cases: a null or empty text has the end id only. Every row is a document of its own, also if
its doc_id is null (sorted first) or repeated; equal documents stand side by side and are dealt to
ranges by doc_id and row. A text longer than a slice stands alone in one; its ids take one row. An
empty table gives no pieces. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelens.llm.text import bounded_batches, slices, texts
from tradelens.llm.tokens import Words, per_worker, vocabulary_bytes
from tradelens.session import materialise, range_width

VOCABULARY = "word_bpe_49k.json"
END, LENGTH = 2, 4096
BUCKET_BITS, DIMENSIONS, BITS = 9, 4, 15
ONE = 1 << 16  # fixed point of a projection


def _signs() -> np.ndarray:
    """A fixed random sign for every bucket and dimension."""
    x = np.arange((1 << BUCKET_BITS) * DIMENSIONS, dtype=np.uint64) + np.uint64(1)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (1 - 2 * (x >> np.uint64(63)).astype(np.int64)).reshape(-1, DIMENSIONS)


def _buckets(ids: int) -> np.ndarray:
    spun = np.arange(ids, dtype=np.uint64) * np.uint64(2654435761) & np.uint64(0xFFFFFFFF)
    return (spun >> np.uint64(32 - BUCKET_BITS)).astype(np.int64)


def projected(ids: np.ndarray, ptr: np.ndarray, bucket: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Each document's damped, normalised bucket counts on every dimension, times ``ONE``, floored."""
    count = len(ptr) - 1
    doc = np.repeat(np.arange(count), np.diff(ptr))
    size = 1 << BUCKET_BITS
    held = np.bincount(doc * size + bucket[ids], minlength=count * size).reshape(count, size)
    damped = np.frexp(held)[1].astype(np.int64)  # bits of the count; integers need no order and no BLAS
    length = np.sqrt(np.maximum((damped * damped).sum(axis=1), 1))
    return np.floor(damped @ signs * ONE / length[:, None]).astype(np.int64)


def tokenised(docs: DataFrame, path: str | None = None, end: int = END) -> DataFrame:
    """row, doc_id, size, ids (little-endian, two bytes each if the vocabulary allows), place; written."""
    spark = docs.sparkSession
    bounded_batches(spark)
    file = spark.sparkContext.broadcast(vocabulary_bytes(path, VOCABULARY))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = per_worker("words", [file.value], lambda: Words(file.value))
        highest = max(known.size, end + 1)
        kind = "<u2" if highest <= 1 << 16 else "<u4"
        bucket, signs = _buckets(highest), _signs()
        for batch in slices(batches):
            ids, ptr = known.ids([data.decode("utf-8", "replace") for data in texts(batch).to_pylist()])
            count = batch.num_rows
            place = projected(ids, ptr, bucket, signs)
            ids = np.insert(ids, ptr[1:], end)
            ptr = ptr + np.arange(count + 1)
            data = ids.astype(kind)
            binary = pa.Array.from_buffers(pa.binary(), count, [
                None, pa.py_buffer((ptr * data.itemsize).astype(np.int32)), pa.py_buffer(data)])
            points = pa.ListArray.from_arrays(
                pa.array(np.arange(count + 1) * DIMENSIONS, pa.int32()),
                pa.array(place.ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(ptr), pa.int64()), binary,
                 points, pa.array([data.itemsize] * count, pa.int32())],
                ["row", "doc_id", "size", "ids", "place", "width"])

    numbered = docs.select(F.monotonically_increasing_id().alias("row"),
                           F.col("doc_id").cast("bigint"), "text")
    return materialise(numbered.mapInArrow(
        encode, "row bigint, doc_id bigint, size bigint, ids binary, place array<bigint>, width int"))


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each cell (a row of coordinates below 2^bits).

    Coordinates are turned and reflected from the highest bit down, as Skilling (2004) does, then
    Gray-coded and their bits interleaved.
    """
    x = [cells[:, k].astype(np.int64) for k in range(cells.shape[1])]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for k in range(len(x)):
            set_ = (x[k] >> bit & 1).astype(bool)
            swap = np.where(set_, 0, (x[0] ^ x[k]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[k] = x[k] ^ swap if k else x[0]
    for k in range(1, len(x)):
        x[k] = x[k] ^ x[k - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | ((axis ^ turn) >> bit & 1)
    return key


def grid(place: np.ndarray, mean: np.ndarray, spread_: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Cells of projections: z / (1 + |z|) of the standardised values, cut evenly."""
    z = (place - mean) / spread_
    return np.floor((z / (1 + np.abs(z)) + 1) / 2 * (1 << bits)).astype(np.int64)


def _figures(made: DataFrame) -> dict:
    """Rows, ids, and each dimension's sum and sum of squares: one row to the driver."""
    exact = [F.get("place", F.lit(k)).cast("decimal(38,0)") for k in range(DIMENSIONS)]
    return made.agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("ids"),
                    *[F.sum(x).alias(f"s{k}") for k, x in enumerate(exact)],
                    *[F.sum(x * x).alias(f"q{k}") for k, x in enumerate(exact)]).first().asDict()


def keyed(made: DataFrame, figures: dict) -> DataFrame:
    """row, doc_id, size and the place on the curve, ``key``."""
    rows = max(figures["rows"], 1)
    mean = np.array([int(figures[f"s{k}"] or 0) / rows for k in range(DIMENSIONS)])
    square = np.array([int(figures[f"q{k}"] or 0) / rows for k in range(DIMENSIONS)])
    deviation = np.sqrt(np.maximum(square - mean * mean, 1.0))

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(3).flatten().to_numpy().reshape(-1, DIMENSIONS)
            key = hilbert(grid(place, mean, deviation), BITS)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(key, pa.int64())], ["row", "doc_id", "size", "key"])

    return made.select("row", "doc_id", "size", "place").mapInArrow(
        find, "row bigint, doc_id bigint, size bigint, key bigint")


def starts(ordered: DataFrame, rows: int) -> DataFrame:
    """row and the number of ids that stand before it in the order of (key, doc_id, row).

    The rows are range-sorted and written with their place in the range. The ranges' sizes, one row
    a range, are added up in one task.
    """
    width = range_width(ordered.sparkSession, rows)
    ranged = ordered.repartitionByRange(width, "key", "doc_id", "row") \
        .sortWithinPartitions("key", "doc_id", "row")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, upto = TaskContext.get().partitionId(), 0
        for batch in batches:
            size = batch.column(1).to_numpy()
            at = upto + np.cumsum(size) - size
            upto += int(size.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(at, pa.int64()),
                 pa.array([part] * len(size), pa.int32())], ["row", "size", "at", "part"])

    placed = materialise(ranged.select("row", "size").mapInArrow(
        run, "row bigint, size bigint, at bigint, part int"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy("part").agg(F.sum("size").alias("held")) \
        .select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    return placed.join(ranges, "part").select("row", (F.col("at") + F.col("base")).alias("first"))


def borders(total: int, length: int) -> tuple[int, np.ndarray]:
    """Full sequences, and where the shorter ones after them begin (and the last one ends)."""
    full = total // length
    at, left = [full * length], total % length
    for bit in range(left.bit_length() - 1, -1, -1):
        if left >> bit & 1:
            at.append(at[-1] + (1 << bit))
    return full, np.array(at, np.int64)


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END
           ) -> DataFrame:
    """doc_id, start, length, ids (little-endian, four bytes each), doc_tokens, sequence_id, offset."""
    made = tokenised(docs, path, end)
    figures = _figures(made)
    total = int(figures["ids"] or 0)
    full, tail = borders(total, length)

    def sequence(position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and first position of the sequence that holds a position."""
        late = np.searchsorted(tail, position, "right") - 1
        inside = position < full * length
        number = np.where(inside, position // length, full + late)
        return number, np.where(inside, number * length, tail[np.maximum(late, 0)])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, size, first = (batch.column(n).to_numpy(zero_copy_only=False)
                                for n in ("ids", "size", "first"))
            width = batch.column("width").to_numpy()
            low, high = sequence(first)[0], sequence(first + size - 1)[0]
            times = high - low + 1
            row = np.repeat(np.arange(len(size)), times)
            number = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            begins = np.where(number <= full, number * length,
                              tail[np.clip(number - full, 0, len(tail) - 1)])
            ends = np.where(number < full, begins + length,
                            tail[np.clip(number - full + 1, 0, len(tail) - 1)])
            begin, stop = np.maximum(begins, first[row]), np.minimum(ends, first[row] + size[row])
            here = begin - first[row]
            kept = [np.frombuffer(ids[r], f"<u{w}", n, a * w).astype("<u4").tobytes()
                    for r, w, a, n in zip(row.tolist(), width[row].tolist(), here.tolist(),
                                          (stop - begin).tolist())]
            chosen = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(chosen), pa.array(here), pa.array(stop - begin),
                 pa.array(kept, pa.binary()), pa.array(size[row]), pa.array(number),
                 pa.array(begin - begins)],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    placed = made.drop("place").join(starts(keyed(made, figures), figures["rows"]), "row")
    return placed.mapInArrow(cut, "doc_id bigint, start bigint, length bigint, ids binary, "
                                  "doc_tokens bigint, sequence_id bigint, offset bigint")


def sequences(pieces_: DataFrame) -> DataFrame:
    """sequence_id, ids (as in the pieces) and the pieces' doc_id, offset and length, in order."""
    held = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    found = pieces_.groupBy("sequence_id").agg(held.alias("held"))
    joined = F.aggregate("held", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    parts = F.transform("held", lambda p: F.struct(p["doc_id"].alias("doc_id"),
                                                   p["offset"].alias("offset"),
                                                   p["length"].alias("length")))
    return found.select("sequence_id", joined.alias("ids"), parts.alias("parts"))


def packed(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """The pieces with the checksum of their ids in place of the ids."""
    return pieces(docs, path, length).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
        "offset")
