"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. A word's probability is
the sum over all its segmentations into pieces of the product of their probabilities; the forward
algorithm takes the sum, for all distinct words of a batch at once. A text's score in a language is
the sum of its words' log probabilities; the best language wins.

The probabilities are trained by expectation maximisation on words of labelled documents, about
``TRAIN_DOCS`` of each language, chosen by hash: the documented bound of what is fitted. All documents
are scored, on their whole text. What reaches the driver is bounded by the documents chosen: their
distinct words by language.

Words are letters (Unicode categories L) with the marks on them (M), lower-cased, begun with the
vocabulary's word mark; of words longer than ``LONGEST`` characters every such stretch counts as a
word without a mark. A character that is no piece counts as a piece of small fixed probability.

Defined cases: ``und`` with score 0 for a null text, for one without letters, and if there is nothing
to learn from. Null languages are not learned from. Ties go to the first language by code point.
Every row is predicted on its own; only doc_id, text and, for training, lang are looked at. A text
longer than a slice stands alone in one; its distinct words are scored once. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelens.llm.text import bounded_batches, slices, texts

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
TRAIN_DOCS, ROUNDS = 400, 3
LONGEST, SMOOTHING, UNKNOWN = 32, 0.05, 1e-7
UNDETERMINED = "und"

_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_OF_LETTERS = regex.compile(r"[\p{L}\p{M}]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Vocabulary:
    """Pieces by hash: ``hashes`` sorted, ``longest`` in characters."""

    hashes: np.ndarray
    longest: int

    def __len__(self) -> int:
        return len(self.hashes)


def _step(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = (h ^ c.astype(np.uint64)) * _ODD
    out ^= out >> np.uint64(29)
    return out


def vocabulary(path: str = VOCABULARY) -> Vocabulary:
    """The lower-cased pieces of letters of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    pieces = {p for p in pieces if _OF_LETTERS.fullmatch(p.removeprefix(MARK)) or p == MARK}
    hashes = []
    for piece in pieces:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = _step(h, np.array([ord(c)]))
        hashes.append(h[0])
    return Vocabulary(np.sort(np.array(hashes, np.uint64)), max(map(len, pieces)))


def words_of(text: str) -> list[str]:
    out = []
    for word in _LETTERS.findall(text.lower()):
        if len(word) < LONGEST:
            out.append(MARK + word)
        else:
            out += [word[i:i + LONGEST] for i in range(0, len(word), LONGEST)]
    return out


def _by_length(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the words of each length, and their characters."""
    width = words.dtype.itemsize // 4
    characters = np.ascontiguousarray(words).view(np.uint32).reshape(len(words), width)
    lengths = (characters != 0).sum(axis=1)
    for n in np.unique(lengths):
        if n:
            at = np.flatnonzero(lengths == n)
            for i in range(0, len(at), 20_000):
                part = at[i:i + 20_000]
                yield part, characters[part, :n]


def _pieces(vocabulary: Vocabulary, characters: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
    """(start, stop) -> piece number of that stretch of each word; len(vocabulary) stands for an
    unknown character, one more for no piece."""
    n = characters.shape[1]
    out = {}
    size = len(vocabulary)
    for start in range(n):
        h = np.zeros(len(characters), np.uint64)
        for stop in range(start + 1, min(n, start + vocabulary.longest) + 1):
            h = _step(h, characters[:, stop - 1])
            at = np.minimum(np.searchsorted(vocabulary.hashes, h), size - 1)
            none = size if stop == start + 1 else size + 1
            out[start, stop] = np.where(vocabulary.hashes[at] == h, at, none)
    return out


def _forward(pieces: dict[tuple[int, int], np.ndarray], n: int, table: np.ndarray) -> list[np.ndarray]:
    """Sums over all segmentations of the first 0, 1 .. n characters. ``table``: piece x language."""
    some = next(iter(pieces.values()))
    alpha = [np.ones((len(some), table.shape[1]))]
    for stop in range(1, n + 1):
        total = np.zeros_like(alpha[0])
        for start in range(stop):
            if (start, stop) in pieces:
                total += alpha[start] * table[pieces[start, stop]]
        alpha.append(total)
    return alpha


def log_probabilities(words: np.ndarray, vocabulary: Vocabulary, table: np.ndarray) -> np.ndarray:
    """word x language: the logarithm of the sum over all segmentations."""
    out = np.zeros((len(words), table.shape[1]))
    for at, characters in _by_length(words):
        n = characters.shape[1]
        out[at] = np.log(_forward(_pieces(vocabulary, characters), n, table)[n])
    return out


def _table(counts: np.ndarray) -> np.ndarray:
    """Probabilities from counts (piece x language), with the rows for unknown and for no piece."""
    smoothed = counts + SMOOTHING
    p = smoothed / smoothed.sum(axis=0)
    return np.vstack([p, np.full(p.shape[1], UNKNOWN), np.zeros(p.shape[1])])


def train(words: np.ndarray, languages: np.ndarray, times: np.ndarray, count: int,
          vocabulary: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """The piece table after some rounds of expectation maximisation on counted words."""
    size = len(vocabulary)
    table = _table(np.ones((size, count)))
    grouped = [(at, _pieces(vocabulary, c), c.shape[1]) for at, c in _by_length(words)]
    for _ in range(rounds):
        counts = np.zeros((size + 2) * count)
        for at, pieces, n in grouped:
            of, weight = languages[at], times[at]

            def p(piece: np.ndarray) -> np.ndarray:
                return table[piece, of]

            alpha = [np.ones(len(at))]
            for stop in range(1, n + 1):
                alpha.append(sum(alpha[s] * p(pieces[s, stop]) for s in range(stop)
                                 if (s, stop) in pieces))
            beta = [np.zeros(0)] * n + [np.ones(len(at))]
            for start in range(n - 1, -1, -1):
                beta[start] = sum(beta[s] * p(pieces[start, s]) for s in range(start + 1, n + 1)
                                  if (start, s) in pieces)
            for (start, stop), piece in pieces.items():
                expected = weight * alpha[start] * p(piece) * beta[stop] / alpha[n]
                counts += np.bincount(piece * count + of, expected, len(counts))
        table = _table(counts.reshape(size + 2, count)[:size])
    return table


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        langs, flat = [], []
        for lang, text in zip(batch.column(batch.schema.get_field_index("lang")).to_pylist(),
                              texts(batch).to_pylist()):
            words = words_of(text.decode())
            flat += words
            langs += [lang] * len(words)
        counted = pa.table({"lang": pa.array(langs, pa.string()), "word": pa.array(flat, pa.string())}) \
            .group_by(["lang", "word"]).aggregate([([], "count_all")])
        for part in counted.rename_columns(["lang", "word", "n"]).to_batches():
            yield part


def training_words(docs: DataFrame, most: int = TRAIN_DOCS) -> pa.Table:
    """lang, word, n of about ``most`` documents of each language, all if there are fewer."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()
                        & ~held_out(F.col("doc_id")))
    share = F.least(F.lit(1.0), most / F.count("*"))
    shares = usable.groupBy("lang").agg(share.alias("share")).orderBy("lang").collect()
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) / (1 << 30)
    if not shares:
        return pa.table({"lang": pa.array([], pa.string()), "word": pa.array([], pa.string()),
                         "n": pa.array([], pa.int64())})
    chosen = F.create_map(*[x for r in shares for x in (F.lit(r["lang"]), F.lit(r["share"]))])
    return (usable.where(place < chosen[F.col("lang")]).select("lang", "text")
            .mapInArrow(_count_words, "lang string, word string, n bigint")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")).orderBy("lang", "word").toArrow())


def predict(docs: DataFrame, path: str = VOCABULARY, most: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    bounded_batches(docs.sparkSession)
    known = vocabulary(path)
    sample = training_words(docs, most)
    names = sorted(set(sample["lang"].to_pylist()))
    number = {name: i for i, name in enumerate(names)}
    table = None
    if names:
        table = train(np.array(sample["word"].to_pylist(), str),
                      np.array([number[x] for x in sample["lang"].to_pylist()]),
                      sample["n"].to_numpy().astype(float), len(names), known)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            flat, sizes = [], []
            for text in texts(batch).to_pylist():
                words = words_of(text.decode()) if names else []
                flat += words
                sizes.append(len(words))
            total = np.zeros((len(sizes), max(len(names), 1)))
            if flat:
                coded = pa.array(flat, pa.string()).dictionary_encode()
                values = log_probabilities(np.array(coded.dictionary.to_pylist(), str), known, table)
                of = np.repeat(np.arange(len(sizes)), sizes)
                each = values[coded.indices.to_numpy()]
                for i in range(len(names)):
                    total[:, i] = np.bincount(of, each[:, i], len(sizes))
            best = total.argmax(axis=1)
            share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            some = np.array(sizes) > 0
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(2)),
                 pa.array([names[b] if s else UNDETERMINED for b, s in zip(best, some)], pa.string()),
                 pa.array(np.where(some, share, 0.0))],
                ["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
