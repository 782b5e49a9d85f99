"""Substring dedup by repeated-phrase automata.

A window of ``WIDTH`` words that stands in two places, in one document or in two, is a repeat, and
all words it covers go, in every place. Pieces that can repeat (see ``repeats``) meet in shards.
There, windows that recur word by word are confirmed; consecutive ones of a piece make a passage.
The shard's passages are compiled into one Aho-Corasick automaton over word numbers, and every piece
of every document is streamed through it: what the matches cover is removed.

Defined cases: a null text has no words; documents shorter than the width keep all. Rows are places
of their own, also those that repeat another row or its doc_id, null included; exact repeats get
equal results. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tradelens.llm import repeats
from tradelens.llm.text import slices, texts

WIDTH, GRAM = 35, 8


def _covered(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def passages(pieces: list[list[int]], weights: list[int], width: int) -> set[tuple[int, ...]]:
    """Word sequences of which every window of ``width`` words stands in two places or more."""
    seen: Counter[tuple[int, ...]] = Counter()
    for words, weight in zip(pieces, weights):
        for i in range(len(words) - width + 1):
            seen[tuple(words[i:i + width])] += weight
    found = set()
    for words in pieces:
        again = [(i, i + width) for i in range(len(words) - width + 1)
                 if seen[tuple(words[i:i + width])] > 1]
        start = None
        for at, (a, b) in enumerate(again):
            start = a if start is None else start
            if at + 1 == len(again) or again[at + 1][0] != a + 1:
                found.add(tuple(words[start:b]))
                start = None
    return found


def automaton(sequences: Iterable[tuple[int, ...]]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for sequence in sequences:
        built.add_word(sequence, len(sequence))
    built.make_automaton()
    return built


def kernel(width: int = WIDTH):
    """Compares a shard's pieces; yields the spans of words that recur."""

    def compare(pieces: repeats.Pieces) -> Iterator[tuple[int, int, int, int]]:
        numbers: dict[bytes, int] = {}
        words = [[numbers.setdefault(w, len(numbers)) for w in piece.split(b" ")]
                 for piece in pieces.texts]
        found = passages(words, pieces.weights, width)
        if not found:
            return
        built = automaton(found)
        for piece, places in zip(words, pieces.places):
            spans = _covered((end + 1 - n, end + 1) for end, n in built.iter(tuple(piece)))
            for key, tag, start, _ in places:
                for a, b in spans:
                    yield key, tag, start + a, start + b
    return compare


def repeated(rows: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    unit = repeats.Unit(width, gram, words=True, same_document=True)
    return repeats.repeated_spans(rows, unit, kernel(width))


def deduplicated(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every document."""
    rows = repeats.keyed(docs)

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, totals, removed, digests = [], [], [], []
            keys = batch.column(batch.schema.get_field_index("k")).to_pylist()
            for key, text, spans in zip(keys, texts(batch).to_pylist(), repeats.merged(batch)):
                words = text.split()
                left = [w for part in repeats.kept(words, spans) for w in part]
                ids.append(None if key == repeats.NO_ID else key)
                totals.append(len(words))
                removed.append(len(words) - len(left))
                digests.append(hashlib.sha256(b" ".join(left)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(totals, pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return rows.join(repeated(rows, width, gram), "k", "left").mapInArrow(
        finish, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
