"""Near-duplicate documents by MinHash.

A document's set holds the hashes of its distinct shingles of ``WIDTH`` words, or of as many as the
caller asks for; a shorter text is one shingle. Documents with equal sets are one
class, represented by its smallest doc_id; only representatives go on. ``BANDS`` x ``ROWS`` universal
hash minima are taken of each set. Documents that agree in a whole band meet in a bucket:

1. Every member of a bucket is compared with the bucket's smallest doc_id, first by the minima (one
   byte of each), then, if these leave the similarity possible, by the full sets.
2. Links make components, by alternating large-star and small-star.
3. Where a bucket still holds several components, members of the smaller ones are compared with
   all members of the others, block by block and on full sets, so that no link gets lost through
   the choice of the smallest. Two that stand alone are first compared by two bits of each of their
   minima, inside the join that brings them together. What this finds goes into the components.

Of a bucket's pairs only those that stand alone are all tested, by their two bits: quadratic work in
one task where a bucket holds very many texts that are not similar. None is left out. A pair of similarity 0.8 has no band in common
with probability (1 - 0.8^6)^40 = 5e-6, and fails a comparison of minima with less than 1e-6.

Defined cases: null texts and texts without words have an empty set, are linked with nothing and
are kept. A row without doc_id is linked with nothing: component_id null, kept. Rows that share a
doc_id are judged by their own texts but are one node when links are followed. Columns other than
doc_id and text are not looked at by ``near_duplicates``; ``unique`` carries them along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelens.llm.components import components
from tradelens.llm.text import bounded_batches, slices, texts
from tradelens.session import materialise

BANDS, ROWS = 40, 6
LEAST = 80  # similarity in a hundred
WIDTH = 2  # words of a shingle
SIGMAS = 5  # what an estimate may be off
BLOCK = 1000  # documents compared with as many others in one group

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``width`` words; of all words if they are fewer."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    single, width = h, min(width, len(words))
    h = single[:len(words) - width + 1]
    for i in range(1, width):
        h = h * _MULTIPLIER + single[i:len(words) - width + 1 + i]
    h = h ^ h >> np.uint64(32)
    h = h * _MULTIPLIER
    h ^= h >> np.uint64(29)
    return np.unique(h)


def _family(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed members x -> a x + b (mod 2^32), a odd, of a universal family."""
    rng = np.random.default_rng(20)
    a = rng.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a[:, None], rng.integers(0, 1 << 32, count, dtype=np.uint32)[:, None]


def minima(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(out, (a * x[None, i:i + 2048] + b).min(axis=1), out=out)
    return out


def similar(x: np.ndarray, y: np.ndarray, least: int = LEAST) -> bool:
    """100 * intersection >= least * union, of sorted distinct hashes."""
    if 100 * min(len(x), len(y)) < least * max(len(x), len(y)):
        return False
    both = np.concatenate((x, y))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= least * (len(x) + len(y) - common)


def least_agreeing(least: int = LEAST, count: int = BANDS * ROWS) -> int:
    """Minima that a pair of at least this similarity has in common, but for SIGMAS deviations."""
    p = least / 100
    return int(count * p - SIGMAS * (count * p * (1 - p)) ** 0.5)


def most_differing(least: int = LEAST, count: int = BANDS * ROWS) -> int:
    """Minima of which two bits differ in a pair of at least this similarity, but for SIGMAS."""
    p = 0.75 * (1 - least / 100)
    return int(count * p + SIGMAS * (count * p * (1 - p)) ** 0.5) + 1


def two_bits(low: np.ndarray) -> np.ndarray:
    """The two lowest bits of every minimum, 32 to a number."""
    held = np.zeros(-(-len(low) // 32) * 32, np.uint64)
    held[:len(low)] = low & np.uint32(3)
    places = np.arange(0, 64, 2, dtype=np.uint64)
    return np.bitwise_or.reduce(held.reshape(-1, 32) << places, axis=1)


_EVERY_OTHER = 0x5555555555555555


def differing(a: Column, b: Column, numbers: int) -> Column:
    """How many minima differ in their two bits."""
    total = F.lit(0)
    for i in range(numbers):
        off = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        total += F.bit_count(off.bitwiseOR(F.shiftrightunsigned(off, 1)).bitwiseAND(F.lit(_EVERY_OTHER)))
    return total


def _features(bands: int, rows: int, width: int):
    a, b = _family(bands * rows)
    place = np.arange(bands, dtype=np.uint64)

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text in texts(batch).to_pylist():
                hashes = shingles(text, width)
                low = minima(hashes, a, b)
                key = np.full(bands, 0, np.uint64) + place
                for part in low.reshape(bands, rows).T:
                    key = (key ^ part) * _MULTIPLIER
                    key ^= key >> np.uint64(31)
                out.append((len(hashes), hashlib.blake2b(hashes.tobytes(), digest_size=16).digest(),
                            key.astype(np.int64) if len(hashes) else None,
                            (low & np.uint32(255)).astype(np.uint8).tobytes(),
                            two_bits(low).astype(np.int64)))
            n, digest, keys, low, bits = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(n, pa.int64()),
                 pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(low, pa.binary()), pa.array(bits, pa.list_(pa.int64()))],
                ["doc_id", "n", "digest", "keys", "minima", "bits"])
    return describe


def _ids(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def _confirm(least: int, count: int, width: int):
    """Of candidate pairs (a, b, with texts and minima) those that are similar."""
    agreeing = least_agreeing(least, count)

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes, np.ndarray] = (b"", np.zeros(0, np.uint64))
        for batch in batches:
            us, vs = [], []
            columns = [batch.column(i) for i in range(4)]
            for u, v, low_u, low_v, text_u, text_v in zip(
                    *(c.to_pylist() for c in columns), texts(batch, "text_u"), texts(batch, "text_v")):
                same = np.frombuffer(low_u, np.uint8) == np.frombuffer(low_v, np.uint8)
                if same.sum() < agreeing:
                    continue
                text_u = text_u.as_py()
                if text_u != last[0]:
                    last = text_u, shingles(text_u, width)
                if similar(last[1], shingles(text_v.as_py(), width), least):
                    us.append(u)
                    vs.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())],
                                             ["u", "v"])
    return confirm


def _across(least: int, width: int):
    """Links between the documents of a block and those sent to it: one for each of the latter."""

    def compare(block: pa.Table, sent: pa.Table) -> pa.Table:
        sets = [shingles(t, width) for t in texts_of(block)]
        nodes = block["node"].to_pylist()
        us, vs = [], []
        if sets and sent.num_rows:
            flat = np.concatenate(sets)
            of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            order = np.argsort(flat, kind="stable")
            flat, of = flat[order], of[order]
            size = np.array([len(s) for s in sets])
            for node, text in zip(sent["node"].to_pylist(), texts_of(sent)):
                mine = shingles(text, width)
                a, b = np.searchsorted(flat, mine), np.searchsorted(flat, mine, "right")
                n = b - a
                places = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
                common = np.bincount(of[places], minlength=len(sets))
                good = np.flatnonzero(100 * common >= least * (size + len(mine) - common))
                if len(good):
                    us.append(node)
                    vs.append(nodes[good[0]])
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})
    return compare


def texts_of(table: pa.Table) -> list[bytes]:
    return [t or b"" for t in table["text"].cast(pa.large_binary()).to_pylist()]


def _leftover(shared: DataFrame, found: DataFrame, pool: DataFrame, least: int, bands: int,
              rows: int, width: int) -> DataFrame:
    """Links between components that buckets still hold side by side."""
    named = shared.select("key", "node").join(found, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component"))
    held = named.groupBy("key", "component").agg(F.count("node").alias("n"))
    mixed = held.groupBy("key").agg(F.count("component").alias("parts")).where("parts > 1")
    held = held.join(mixed.select("key"), "key", "left_semi")
    # The bits of those that stand alone in their bucket; a larger component has none.
    alone = F.when(F.col("n") == 1, F.col("bits"))
    mine = named.join(held, ["key", "component"]).join(pool.select("node", "bits"), "node") \
        .withColumn("bits", alone)
    other = mine.groupBy("key", F.col("component").alias("to")).agg(
        F.first("n").alias("m"), F.first("bits").alias("other"))
    # Members of the smaller component of two go to the larger one.
    smaller = F.struct("n", "component") < F.struct("m", "to")
    count = -(-bands * rows // 32)
    near = F.coalesce(differing(F.col("bits"), F.col("other"), count)
                      <= most_differing(least, bands * rows), F.lit(True))
    mine = mine.withColumnRenamed("key", "in")
    sent = mine.join(other, (mine["in"] == other["key"]) & smaller & near).select("node", "to").distinct()
    sent = materialise(sent)

    parts = sent.groupBy("to").agg(F.ceil(F.count("node") / BLOCK).cast("int").alias("columns"))
    members = (found.join(parts, found["component"] == parts["to"]).select("to", "node", "columns")
               .union(parts.join(found, found["component"] == parts["to"], "left_anti")
                      .select("to", F.col("to").alias("node"), "columns")))
    sizes = members.groupBy("to").agg(F.ceil(F.count("node") / BLOCK).cast("int").alias("rows"),
                                      F.first("columns").alias("columns"))
    spread = F.pmod(F.hash("node"), F.col("rows"))
    lift = F.pmod(F.hash("node"), F.col("columns"))
    blocks = (members.drop("columns").join(sizes, "to").withColumn("row", spread)
              .withColumn("column", F.explode(F.sequence(F.lit(0), F.col("columns") - 1))))
    asked = (sent.join(sizes, "to").withColumn("column", lift)
             .withColumn("row", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))))
    what = pool.select("node", "text")

    def grouped(side: DataFrame):
        return side.join(what, "node").select(*[
            F.col(c).alias(c) for c in ("to", "row", "column", "node", "text")
        ]).groupBy("to", "row", "column")

    return grouped(blocks).cogroup(grouped(asked)).applyInArrow(
        _across(least, width), "u bigint, v bigint")


def near_duplicates(docs: DataFrame, least: int = LEAST, bands: int = BANDS,
                    rows: int = ROWS, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    bounded_batches(docs.sparkSession)
    ids = _ids(docs)
    features = materialise(ids.mapInArrow(
        _features(bands, rows, width),
        "doc_id bigint, n bigint, digest binary, keys array<bigint>, minima binary, bits array<bigint>"))
    real = features.where("n > 0 AND doc_id IS NOT NULL")
    classes = real.groupBy("digest").agg(F.min("doc_id").alias("node"))

    first = real.join(classes.withColumnRenamed("node", "doc_id"), ["digest", "doc_id"], "left_semi")
    buckets = first.select(F.col("doc_id").alias("node"), F.explode("keys").alias("key"))
    heads = buckets.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last")) \
        .where("head < last").select("key", "head")
    shared = materialise(buckets.join(heads, "key"))

    low = first.select(F.col("doc_id").alias("node"), "minima", "bits")
    pool = shared.select("node").distinct().join(low, "node")
    pool = materialise(pool.join(ids.withColumnRenamed("doc_id", "node"), "node"))
    pairs = shared.where("node > head").select("head", "node").distinct()
    one = pool.select(*[F.col(c).alias(f"{c}_u") for c in ("node", "minima", "text")])
    two = pool.select(*[F.col(c).alias(f"{c}_v") for c in ("node", "minima", "text")])
    links = materialise(
        pairs.join(two, pairs["node"] == two["node_v"]).join(one, pairs["head"] == one["node_u"])
        .select("node_u", "node_v", "minima_u", "minima_v", "text_u", "text_v")
        .mapInArrow(_confirm(least, bands * rows, width), "u bigint, v bigint"))

    found = materialise(components(links))
    more = materialise(_leftover(shared, found, pool, least, bands, rows, width))
    if not more.isEmpty():
        tied = found.select(F.col("node").alias("u"), F.col("component").alias("v"))
        found = materialise(components(tied.union(more)))

    placed = classes.join(found, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component"))
    joined = features.join(placed, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.least("component", "doc_id")).otherwise(F.col("doc_id"))
        .alias("component_id"))
    joined = joined.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return joined.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def unique(docs: DataFrame, least: int = LEAST, width: int = WIDTH) -> DataFrame:
    """One document of each group, with all its columns; of rows that repeat its doc_id all."""
    gone = near_duplicates(docs, least, width=width).where(~F.col("kept"))
    gone = gone.select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("bigint") == gone["gone"], "left_anti")
