"""Benchmark decontamination by template windows.

Words are brought into a canonical form: lower case without outer punctuation, numbers, units of
measure and names (capitalised words inside a sentence) replaced by a placeholder of their type. A
capitalised word that opens a sentence may be a plain word or a name: it matches an equal word, and
as a name any name and any other such word. Every window of ``WINDOW`` canonical words with enough
plain ones, in each reading of its openers, is looked up in a hash table of the benchmark items'
windows. Hits on one diagonal (document place less item place) make a run, compared
word by word; its slots must be consistent: equal values in the item stand for equal values in the
document, and different ones for different ones. So a question asked again with other numbers or
names is found, a chance pattern of numbers is not. A document is contaminated if a consistent run
has ``LEAST_RUN`` words or more.

The table of items is sent to all tasks in blocks of at most ``BLOCK_WORDS`` words, one pass over the
documents for each block; a usual benchmark is one block. Documents are not shuffled.

Defined cases: null and empty texts are clean; a null or short item (fewer words than a run) is
found only as a whole, items without a window of enough plain words never. Repeated items and rows each count for
themselves; a null item_id is reported as null. Columns other than doc_id and text are not looked
at by ``matches``; ``clean`` carries them along.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm.repeats import rolled
from tradelens.llm.text import WORD, bounded_batches, slices, texts

WINDOW, LEAST_PLAIN, LEAST_RUN = 8, 5, 12
BLOCK_WORDS = 2_000_000
CACHED_WORDS = 400_000
READ_AT_ONCE = 1 << 14  # windows whose readings are held together

# Units of measure that become placeholders.
UNITS = frozenset("""
mm cm m km inch inches foot feet yard yards mile miles g mg kg gram grams kilogram kilograms ton
tons ounce ounces pound pounds ml l liter liters litre litres gallon gallons s sec second seconds
min minute minutes hour hours day days week weeks month months year years dollar dollars cent cents
euro euros percent degree degrees meter meters metre metres kilometer kilometers kilometre kilometres
""".split())

_OUTER = re.compile(r"^[\W_]+|[\W_]+$")
_NUMBER = re.compile(r"[0-9][0-9.,:/]*(?:st|nd|rd|th)?")
_STOPS = (".", "!", "?", ":")
_ASCII_OUTER = bytes(c for c in range(128) if not chr(c).isalnum())
_UNITS = frozenset(u.encode() for u in UNITS)
NUMBER, UNIT, NAME = 1, 2, 3
_SLOT_HASH = {kind: np.uint64(0xA24BAED4963EE407 * kind % (1 << 64)) for kind in (NUMBER, UNIT, NAME)}


class Words(dict):
    """Raw word -> hash of its canonical form, with its type and its place in sentences below.

    The lowest bits: 0-1 placeholder type, 2 capitalised, 3 ends a sentence, 4 nothing but
    punctuation. Forgets all when it has grown too large, so a task's memory is bounded.
    """

    def __missing__(self, raw: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        if raw.isascii():
            return self._of_ascii(raw)
        text = raw.decode()
        word = _OUTER.sub("", text)
        flags = 0
        if not word:
            flags |= 16
        elif _NUMBER.fullmatch(word):
            flags |= NUMBER
        elif word.lower() in UNITS:
            flags |= UNIT
        elif word[0].isupper():
            flags |= 4
        if text.endswith(_STOPS):
            flags |= 8
        code = xxhash.xxh3_64_intdigest(word.lower().encode()) & ~31 | flags
        self[raw] = code
        return code

    def _of_ascii(self, raw: bytes) -> int:
        """The same without decoding and, for all but numbers, without patterns."""
        word = raw.strip(_ASCII_OUTER)
        low = word.lower()
        if not word:
            flags = 16
        elif low in _UNITS:
            flags = UNIT
        elif 48 <= word[0] <= 57:
            flags = NUMBER if _NUMBER.fullmatch(word.decode()) else 0
        else:
            flags = 4 if 65 <= word[0] <= 90 else 0
        if raw[-1] in b".!?:":
            flags |= 8
        self[raw] = code = xxhash.xxh3_64_intdigest(low) & ~31 | flags
        return code


class Template:
    """A text's canonical words: ``codes`` (hashes), ``slots`` (placeholder types, 0 for plain words),
    ``values`` (the hashes of what the placeholders stand for) and ``openers`` (capitalised words that
    open a sentence: plain in ``codes`` and ``slots``, but maybe names)."""

    def __init__(self, raw: list[bytes], cache: Words, doc: np.ndarray | None = None):
        packed = np.fromiter(map(cache.__getitem__, raw), np.uint64, len(raw))
        full = packed & np.uint64(16) == 0
        self.full = full
        packed = packed[full]
        self.doc = np.zeros(len(packed), np.int64) if doc is None else doc[full]
        flags = packed & np.uint64(31)
        kind = (flags & np.uint64(3)).astype(np.int8)
        inside = np.zeros(len(packed), bool)  # not the first word of a sentence or text
        inside[1:] = ((flags[:-1] & np.uint64(8)) == 0) & (self.doc[1:] == self.doc[:-1])
        capital = (flags & np.uint64(4)) > 0
        kind[inside & capital] = NAME
        self.slots = kind
        self.openers = capital & ~inside
        self.values = packed & ~np.uint64(31)
        self.codes = self.values.copy()
        for slot, code in _SLOT_HASH.items():
            self.codes[kind == slot] = code

    def windows(self, size: int, plain: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the windows that have enough plain words, and their hashes, part by part.

        A window with openers comes once for each choice of those taken as names.
        """
        n = max(len(self.codes) - size + 1, 0)
        upto = np.append(0, np.cumsum(self.slots == 0))
        openers = np.append(0, np.cumsum(self.openers))
        free = upto[size:] - upto[:n] - plain  # how many openers may be names
        good = (free >= 0) & (self.doc[size - 1:] == self.doc[:n])
        at = np.flatnonzero(good)
        if len(at):
            yield at, rolled(self.codes, size)[at]
        at = np.flatnonzero(good & (free > 0) & (openers[size:] > openers[:n]))
        for part in np.split(at, range(READ_AT_ONCE, len(at), READ_AT_ONCE)):
            chosen = np.zeros(len(part), np.int64)  # a bit for each word taken as a name
            left = free[part]
            for place in range(size):
                more = np.flatnonzero((left > 0) & self.openers[part + place])
                part = np.append(part, part[more])
                chosen = np.append(chosen, chosen[more] | 1 << place)
                left = np.append(left, left[more] - 1)
            part, chosen = part[chosen > 0], chosen[chosen > 0]
            for first in range(0, len(part), READ_AT_ONCE):
                where = part[first:first + READ_AT_ONCE]
                names = chosen[first:first + READ_AT_ONCE, None] >> np.arange(size) & 1
                codes = np.where(names > 0, _SLOT_HASH[NAME], self.codes[where[:, None] + np.arange(size)])
                yield where, rolled(codes.ravel(), size)[::size]

    def all_windows(self, size: int, plain: int) -> tuple[np.ndarray, np.ndarray]:
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.uint64)), *self.windows(size, plain)]
        return np.concatenate([p for p, _ in parts]), np.concatenate([h for _, h in parts])


def matched_as(item: Template, document: Template, a: int, b: int) -> int:
    """How two words match: -1 not at all, 0 as plain words, else as slots of this type."""
    x, y = int(item.slots[a]), int(document.slots[b])
    either, other = item.openers[a], document.openers[b]
    if not (either or other):
        return x if item.codes[a] == document.codes[b] else -1
    if x in (0, NAME) and y in (0, NAME) and item.values[a] == document.values[b]:
        return 0
    return NAME if (either or x == NAME) and (other or y == NAME) else -1


def longest_consistent(item: Template, document: Template, a: int, b: int, n: int) -> int:
    """Words of the longest stretch in which slots map one to one, of n words from a and from b."""
    there: dict[tuple[int, int], tuple[int, int]] = {}  # value there, and where that was last
    back: dict[tuple[int, int], tuple[int, int]] = {}
    best = left = 0
    for i in range(n):
        kind = matched_as(item, document, a + i, b + i)
        if kind < 0:
            left = i + 1
            continue
        if kind:
            x, y = int(item.values[a + i]), int(document.values[b + i])
            for seen, value, other in ((there, x, y), (back, y, x)):
                held, place = seen.get((kind, value), (other, -1))
                if held != other:  # what maps otherwise is left behind
                    left = max(left, place + 1)
                seen[kind, value] = other, i
        best = max(best, i + 1 - left)
    return best


def stretched(item: Template, document: Template, a: int, b: int, n: int) -> tuple[int, int, int]:
    """The run of n words from a and from b, longer by what is equal before it and after it."""
    doc = document.doc[b]
    while a and b and document.doc[b - 1] == doc and matched_as(item, document, a - 1, b - 1) >= 0:
        a, b, n = a - 1, b - 1, n + 1
    while (a + n < len(item.codes) and b + n < len(document.codes) and document.doc[b + n] == doc
           and matched_as(item, document, a + n, b + n) >= 0):
        n += 1
    return a, b, n


class Table:
    """The windows of a block of items, sorted by hash."""

    def __init__(self, items: list[tuple[int | None, bytes]], window: int, plain: int):
        cache = Words()
        self.ids = [i for i, _ in items]
        self.items = [Template(text.split(), cache) for _, text in items]
        hashes, of, at = [], [], []
        for number, item in enumerate(self.items):
            places, found = item.all_windows(window, plain)
            hashes.append(found)
            of.append(np.full(len(places), number))
            at.append(places)
        joined = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(joined, kind="stable")
        self.hashes = joined[order]
        self.of = np.concatenate(of)[order] if of else np.zeros(0, np.int64)
        self.at = np.concatenate(at)[order] if at else np.zeros(0, np.int64)
        self.unseen = np.uint64(64 - min(len(joined).bit_length() + 4, 24))
        self.begun = np.zeros(1 << 64 - int(self.unseen), bool)  # highest bits of some hash
        self.begun[joined >> self.unseen] = True

    def hits(self, at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the table with one of ``hashes``, and the place in ``at`` of each."""
        maybe = np.flatnonzero(self.begun[hashes >> self.unseen])
        at, hashes = at[maybe], hashes[maybe]
        low = np.searchsorted(self.hashes, hashes)
        hit = np.flatnonzero(self.hashes[np.minimum(low, max(len(self.hashes) - 1, 0))] == hashes) \
            if len(self.hashes) else np.zeros(0, np.int64)
        at, low = at[hit], low[hit]
        many = np.searchsorted(self.hashes, hashes[hit], "right") - low
        row = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
        return row, np.repeat(at, many)


def _find(table: Table, window: int, plain: int, least: int):
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Words()
        for batch in slices(batches):
            raw = [t.split() for t in texts(batch).to_pylist()]
            doc = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
            text = Template([w for r in raw for w in r], cache, doc)
            hits = [table.hits(at, hashes) for at, hashes in text.windows(window, plain)]
            row = np.concatenate([r for r, _ in hits] or [np.zeros(0, np.int64)])
            place = np.concatenate([p for _, p in hits] or [np.zeros(0, np.int64)])
            item, start = table.of[row], table.at[row]
            order = np.lexsort((place, place - start, item, text.doc[place]))
            place, item, start = place[order], item[order], start[order]
            where = text.doc[place]
            new = np.ones(len(place), bool)
            new[1:] = ((np.diff(where) != 0) | (np.diff(item) != 0)
                       | (np.diff(place - start) != 0) | (np.diff(place) > window))
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(place)) - 1
            found: list[dict] = [{} for _ in raw]
            for f, e in zip(first.tolist(), last.tolist()):
                number = int(item[f])
                other = table.items[number]
                n = int(place[e] - place[f]) + window
                a, b, n = stretched(other, text, int(start[f]), int(place[f]), n)
                run = longest_consistent(other, text, a, b, n)
                if run >= min(least, len(other.codes)):
                    mine = found[where[f]]
                    mine[number] = max(mine.get(number, 0), run)
            rows = [sorted(((table.ids[i] is None, table.ids[i] or 0), i) for i in f) for f in found]
            before = batch.select(["items", "longest_run"]).to_pylist()
            items = [old["items"] + [table.ids[i] for _, i in r] for old, r in zip(before, rows)]
            longest = [max(f.values(), default=0) for f in found]
            out = {"items": pa.array(items, pa.list_(pa.int64())),
                   "longest_run": pa.array([max(old["longest_run"], n)
                                            for old, n in zip(before, longest)], pa.int64())}
            yield pa.RecordBatch.from_arrays(
                [out.get(name, column) for name, column in zip(batch.schema.names, batch.columns)],
                batch.schema.names)
    return find


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, bytes]]]:
    """The items in blocks of bounded size: one, or as many as their words need."""
    items = benchmark.where("text IS NOT NULL").select(
        F.col("item_id").cast("bigint").alias("item_id"), "text")
    words = items.agg(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0] or 0
    count = -(-words // BLOCK_WORDS) or 1
    for block in range(count):
        mine = items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(count)) == block)
        yield [(r[0], r[1].encode()) for r in mine.orderBy("item_id", "text").collect()]


def matched(rows: DataFrame, benchmark: DataFrame, window: int = WINDOW, plain: int = LEAST_PLAIN,
            least: int = LEAST_RUN) -> DataFrame:
    """``rows`` (with text) and, of every document, items (those it holds) and longest_run.

    Every block of items is one more pass of the same rows; what is found is carried along.
    """
    bounded_batches(rows.sparkSession)
    found = rows.withColumns({"items": F.array().cast("array<bigint>"),
                              "longest_run": F.lit(0).cast("bigint")})
    for block in _blocks(benchmark):
        found = found.mapInArrow(_find(Table(block, window, plain), window, plain, least),
                                 found.schema)
    return found


def matches(docs: DataFrame, benchmark: DataFrame, least: int = LEAST_RUN) -> DataFrame:
    """doc_id, items, longest_run, contaminated, kept for every document."""
    found = matched(docs.select("doc_id", "text"), benchmark, least=least)
    leaks = F.size("items") > 0
    return found.select("doc_id", F.array_sort("items").alias("items"), "longest_run",
                        leaks.alias("contaminated"), (~leaks).alias("kept"))


def clean(docs: DataFrame, benchmark: DataFrame, least: int = LEAST_RUN) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    rows = docs.select(F.struct("*").alias("row"), "text")
    return matched(rows, benchmark, least=least).where(F.size("items") == 0).select("row.*")
