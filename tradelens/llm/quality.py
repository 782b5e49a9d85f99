"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Texts are counted as hashed byte n-grams, once over all documents (raw) and once over those that
labels call good and not toxic (target). With T and R n-grams in all, a bucket with t target and r
raw counts scores log((t + a) / (r T / R + a)): target counts against those expected if the target
were like the corpus, both smoothed by a fixed share of T. A document's score is the mean over its
n-grams, so length does not count. The same ratio is taken of hashed single words, counted once a
document: a mean hides a few abusive words in a long text, the worst word does not. A document is
kept if score and worst word reach fixed thresholds. Nothing is drawn at random, and all sums are of
integers, so a verdict depends on no other document of the batch.

Besides, simple counts: words, characters in words, symbols, repeated lines, and words in repeated
3-word windows; a document with too few words or too many repeated ones fails whatever its score.

The target is fitted on at most ``TRUSTED`` labelled documents, those of the smallest hashed ids
(the documented bound of what the driver holds, together with the 2^16 bucket scores and the bad
words); the raw counts are of all documents. A word can only be bad if about one document in a
hundred has it, so there are at most a hundred times as many as a document has words on average.

Defined cases: a null text has no words and score 0; so has a text shorter than an n-gram. A text
longer than a slice stands alone in one, with some 20 bytes of numbers for each of its bytes. An empty
table gives an empty result. Labels
that contradict each other, or are null, do not make a document trusted. Without trusted documents
every score is 0. Every row is judged on its own, whatever its doc_id. Columns other than doc_id
and text are not looked at by ``judge``; ``kept`` carries them along.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from tradelens.llm.text import bounded_batches, slices, texts
from tradelens.llm.tokens import KEPT_WORDS, looked_up
from tradelens.session import materialise

GRAM, BUCKETS = 4, 1 << 16
TRUSTED = 50_000
SMOOTHING, WORD_SMOOTHING = 5e-6, 5e-4  # shares of the target's n-grams, of its documents
LEAST_SCORE, LEAST_WORD = -0.2, -3.0
ONE = 1 << 36  # fixed point of a bucket's score
LEAST_WORDS, MOST_REPEATED = 50, 50  # words; repeated words in a hundred
# Separators of words, and symbols.
SPACES, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"


def gram_buckets(text: bytes) -> np.ndarray:
    """The bucket of the n-gram at each byte of ``text``; of the last ones, which run out, too."""
    out = np.empty(len(text) + 1, "<u4")
    padded = text + bytes(8)
    for o in range(4):
        part = out[o::4]
        part[:] = np.frombuffer(padded, "<u4", len(part), o)
    return ((out[:len(text)] * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)


class Ratios(NamedTuple):
    """Log-likelihood ratios: of every bucket in units of 1 / ``ONE``, and of the bad words by hash."""

    buckets: np.ndarray
    words: np.ndarray
    worst: np.ndarray


LETTERS = re.compile(rb"[a-z\x80-\xff]+")


class Words:
    """Numbers of words, in lower case, and their hashes; a task begins anew when it knows too many."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.hashes: list[int] = []

    def _learn(self, new: list[bytes]) -> None:
        import xxhash
        self.hashes += [xxhash.xxh64_intdigest(w) for w in new]
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))

    def full(self) -> bool:
        return len(self.known) > KEPT_WORDS

    def hash(self) -> np.ndarray:
        return np.array(self.hashes, np.uint64).view(np.int64)

    def of(self, held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(document, number) of every word of each text."""
        found = [LETTERS.findall(text.lower()) for text in held]
        doc = np.repeat(np.arange(len(held)), [len(words) for words in found])
        return doc, looked_up(self.known, list(chain.from_iterable(found)), self._learn)


class Documents:
    """How many documents have each word, all and trusted ones."""

    def __init__(self):
        self.words = Words()
        self.raw, self.target = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, held: list[bytes], good: np.ndarray) -> None:
        doc, number = self.words.of(held)
        size = len(self.words.known)
        once = np.unique(doc * size + number) if size else number
        doc, number = once // max(size, 1), once % max(size, 1)
        more = np.zeros(size - len(self.raw), np.int64)
        self.raw = np.append(self.raw, more) + np.bincount(number, minlength=size)
        self.target = np.append(self.target, more) + np.bincount(number[good[doc]], minlength=size)

    def counted(self) -> pa.RecordBatch:
        return _counted(self.words.hash(), True, self.target, self.raw)


def trusted_ids(labels: DataFrame, most: int = TRUSTED) -> list[int]:
    """At most ``most`` documents that all their labels call good and not toxic."""
    good = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False)))
        .alias("good")).where("good")
    return [r[0] for r in good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
            .select("doc_id").collect()]


def _is_trusted(batch: pa.RecordBatch, trusted: np.ndarray) -> np.ndarray:
    ids = batch.column(batch.schema.get_field_index("doc_id"))
    good = np.isin(ids.fill_null(0).to_numpy(zero_copy_only=False), trusted)
    return good & ~np.asarray(ids.is_null())


def _counted(place: np.ndarray, is_word: bool, target: np.ndarray, raw: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(place, pa.int64()), pa.array(np.full(len(place), is_word)), pa.array(target, pa.int64()),
         pa.array(raw, pa.int64())], ["place", "word", "target", "raw"])


def _counts(trusted: np.ndarray):
    """n-grams by bucket, and documents by word; the bucket after the last one counts documents."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS + 1, np.int64), np.zeros(BUCKETS + 1, np.int64)
        documents = Documents()
        for batch in slices(batches):
            good = _is_trusted(batch, trusted)
            held = texts(batch).to_pylist()
            lengths = np.array([len(t) for t in held], np.int64)
            buckets = gram_buckets(b"".join(held))
            ends = np.cumsum(lengths)
            whole = np.ones(len(buckets), bool)
            for back in range(1, GRAM):  # n-grams that run into the next text
                whole[np.maximum(ends - back, 0)[lengths >= back]] = False
            raw += np.bincount(buckets[whole], minlength=BUCKETS + 1)
            target += np.bincount(buckets[whole & np.repeat(good, lengths)], minlength=BUCKETS + 1)
            raw[BUCKETS] += len(held)
            target[BUCKETS] += good.sum()
            documents.add(held, good)
            if documents.words.full():
                yield documents.counted()
                documents = Documents()
        yield documents.counted()
        seen = np.flatnonzero(raw)
        yield _counted(seen, False, target[seen], raw[seen])
    return count


def ratios(docs: DataFrame, labels: DataFrame, most: int = TRUSTED, least: float = LEAST_WORD) -> Ratios:
    """The log-likelihood ratios of all buckets and of the words below ``least``."""
    bounded_batches(docs.sparkSession)
    trusted = np.sort(np.array(trusted_ids(labels, most), np.int64))
    counted = materialise(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .mapInArrow(_counts(trusted), "place bigint, word boolean, target bigint, raw bigint")
        .groupBy("place", "word").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")))
    rows = counted.where("NOT word").toArrow()
    target, raw = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    target[rows["place"].to_numpy()] = rows["target"].to_numpy()
    raw[rows["place"].to_numpy()] = rows["raw"].to_numpy()
    (grams, documents), (all_grams, all_documents) = ((x[:BUCKETS].sum(), x[BUCKETS]) for x in (target, raw))
    nothing = Ratios(np.zeros(BUCKETS, np.int64), np.empty(0, np.int64), np.empty(0))
    if not grams:
        return nothing
    share = SMOOTHING * grams
    scores = np.log((target[:BUCKETS] + share) / (raw[:BUCKETS] * (grams / all_grams) + share))
    share = WORD_SMOOTHING * documents
    ratio = F.log((F.col("target") + share) / (F.col("raw") * (documents / all_documents) + share))
    bad = counted.where("word").select("place", ratio.alias("ratio")).where(F.col("ratio") < least) \
        .orderBy("place").toArrow()
    return Ratios(np.rint(scores * ONE).astype(np.int64), bad["place"].to_numpy(), bad["ratio"].to_numpy())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    inside = text.translate(None, SPACES)
    characters = len(inside.decode())
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    triples = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(triples)) < len(triples):
        often = Counter(triples)
        upto = 0  # words before this place are counted
        for i, triple in enumerate(triples):
            if often[triple] > 1:
                repeated += i + 3 - max(upto, i)
                upto = i + 3
    return len(words), characters, symbols, len(lines) - len(set(lines)), repeated


_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judged(rows: DataFrame, found: Ratios, least: float = LEAST_SCORE) -> DataFrame:
    """``rows``, which have a text, with the verdict's columns; the text itself is left out."""
    carried = [f for f in rows.schema.fields if f.name != "text"]
    schema = StructType([*carried, *(StructField(name, LongType()) for name in _NAMES),
                         StructField("base_failed", BooleanType()), StructField("score", DoubleType()),
                         StructField("worst_word", DoubleType()), StructField("kept", BooleanType())])

    def judge_(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in slices(batches):
            held = texts(batch).to_pylist()
            lengths = np.array([len(t) for t in held], np.int64)
            counts = np.array([base_counts(t) for t in held], np.int64).T
            upto = np.append(0, np.cumsum(found.buckets[gram_buckets(b"".join(held))]))
            first = np.cumsum(lengths) - lengths
            n = np.maximum(lengths - GRAM + 1, 0)
            score = (upto[first + n] - upto[first]) / np.maximum(n, 1) / ONE
            worst = np.zeros(len(held))
            if len(found.words):
                known = Words() if known.full() else known
                doc, number = known.of(held)
                hashes = known.hash()
                at = np.minimum(np.searchsorted(found.words, hashes), len(found.words) - 1)
                bad = np.where(found.words[at] == hashes, found.worst[at], 0.0)[number] if len(number) else worst
                hit = np.flatnonzero(bad)
                np.minimum.at(worst, doc[hit], bad[hit])
            failed = (counts[0] < LEAST_WORDS) | (100 * counts[4] > MOST_REPEATED * counts[0])
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in carried]
            yield pa.RecordBatch.from_arrays(
                [*columns, *(pa.array(c) for c in counts), pa.array(failed), pa.array(score), pa.array(worst),
                 pa.array(~failed & (score >= least) & (worst == 0))],
                [*(f.name for f in carried), *_NAMES, "base_failed", "score", "worst_word", "kept"])

    return rows.mapInArrow(judge_, schema)


def judge(docs: DataFrame, labels: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """doc_id, the counts, base_failed, score, worst_word (0 if no word is bad) and kept of every document."""
    return judged(docs.select("doc_id", "text"), ratios(docs, labels), least)


def kept(docs: DataFrame, labels: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    rows = docs.select(F.struct("*").alias("row"), "text")
    return judged(rows, ratios(docs, labels), least).where("kept").select("row.*")
