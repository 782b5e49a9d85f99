"""Substring dedup by suffix arrays.

Bytes covered by a string of ``WIDTH`` bytes that also starts in a document of smaller doc_id are
repeats. Pieces that can repeat (see ``repeats``) meet in shards. Of a shard's different pieces the
stretches whose windows recur there, by their hashes, get suffix arrays of bounded size; a window
found once needs none, its piece's smallest document is its own. The suffixes are sorted by their
first bytes and refined as Larsson and Sadakane do, by the ranks of the suffixes that begin where
the compared bytes end, only groups of equal suffixes being sorted again. Common prefixes come from Kasai's rule, a suffix starting with
what its left neighbour in the text had less one. Strings that several arrays of a shard hold are
merged by binary search in sorted order.

Defined cases: a null text is empty; texts shorter than the width have no such string. A null doc_id
counts as larger than all others; documents of one id (null included) are not smaller than each
other, so they lose nothing to each other. Exact repeats of a row get equal results. Columns other
than doc_id and text are not looked at by ``deduplicated``; ``without_repeats`` carries them along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tradelens.llm import repeats
from tradelens.llm.repeats import eight_bytes
from tradelens.llm.text import slices, texts

WIDTH, GRAM = 50, 20
ARRAY_BYTES = 2 << 20
LANES = 32  # neighbouring suffixes along which Kasai's rule is followed


def _refine(order: np.ndarray, rank: np.ndarray, shift: int, wanted: np.ndarray | None
            ) -> tuple[np.ndarray, np.ndarray]:
    """One step: suffixes equal so far are ordered by the rank of what follows ``shift`` bytes on.

    ``order`` holds suffixes sorted so far, ``rank`` the place of each group's first; suffixes that
    are not ``wanted`` are left out of the result. Rank, next rank and suffix make one number where
    they fit in 63 bits: numbers are sorted many times faster than places by a stable sort.
    """
    if wanted is not None:
        order = order[wanted[order]]
    group = rank[order].astype(np.int64)
    edge = np.ones(len(order) + 1, bool)
    np.not_equal(group[1:], group[:-1], out=edge[1:-1])
    new = edge[:-1]
    open_ = ~(new & edge[1:])
    moving = order[open_]
    key = group[open_]
    following = rank[np.minimum(moving + shift, len(rank) - 1)]
    bits = (len(rank) - 1).bit_length()
    if 3 * bits < 64:
        for part in (following, moving):
            key <<= bits
            key |= part
        key.sort()
        moving = key & ((1 << bits) - 1)
        key >>= bits
    else:
        key = key << 32 | following
        sort = np.argsort(key, kind="stable")
        moving, key = moving[sort], key[sort]
    order = order.copy()
    order[open_] = moving
    new[open_] |= np.append(True, key[1:] != key[:-1])[:len(key)]
    out = np.zeros_like(rank)
    out[order] = np.maximum.accumulate(np.where(new, np.arange(len(order), dtype=rank.dtype), 0))
    return order, out


def suffix_array(text: bytes, starts: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """``starts`` in the order of the first ``width`` (17 to 64) bytes at each of them.

    All of these bytes lie in ``text``. The first bytes and the place of a suffix make one number to
    sort, as many bytes as fit. Ranks then double their reach; the last step overlaps the one before
    so that exactly ``width`` bytes count. Equal suffixes stay ordered by place.
    """
    n = len(text)
    bits = (n - 1).bit_length()
    reach = (64 - bits) // 8
    eight = eight_bytes(text, ">u8")[:n].astype(np.uint64)
    key = eight >> np.uint64(64 - 8 * reach) << np.uint64(bits) | np.arange(n, dtype=np.uint64)
    key.sort()
    order = (key & np.uint64((1 << bits) - 1)).astype(np.int64)
    key >>= np.uint64(bits)
    new = np.append(True, key[1:] != key[:-1])
    rank = np.zeros(n, np.int32 if n < 1 << 31 else np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=rank.dtype), 0))

    here = np.zeros(n, bool)
    here[starts] = True
    while 2 * reach < width:
        wanted = None
        if 4 * reach >= width:  # only these ranks are asked for by the last step
            wanted = here.copy()
            wanted[starts + (width - 2 * reach)] = True
        order, rank = _refine(order, rank, reach, wanted)
        reach *= 2
    order, _ = _refine(order, rank, width - reach, here)
    return order


def common_prefixes(text: bytes, order: np.ndarray, lanes: list[np.ndarray], ends: np.ndarray,
                    width: int = WIDTH) -> np.ndarray:
    """For each suffix, the bytes it has in common with the one before it in ``order``, to width + 1.

    ``lanes``: the first suffixes of all stretches of neighbours, then the second ones, and so on; long
    pieces are cut into several stretches. ``ends``: where the
    piece of each suffix ends, 0 where none starts. Kasai's rule goes along all
    stretches at once: with the suffix before it, a suffix shares what its left neighbour shares with its own
    predecessor, less one, if that predecessor's right neighbour is a suffix of the array. Equal
    suffixes are ordered by place, hence the rule holds for them too, but for a common prefix of
    exactly ``width`` bytes, the last of which decides the order.
    """
    n = len(text)
    eight = eight_bytes(text, "<u8")
    one = np.frombuffer(text + bytes(1), np.uint8)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    common = np.zeros(n, np.int64)
    for i, lane in enumerate(lanes):
        lane = lane[before[lane] >= 0]
        other = before[lane]
        have = np.zeros(len(lane), np.int64)
        if i:
            shared, source = common[lane - 1], before[lane - 1]
            fits = (source >= 0) & (ends[source + 1] == ends[source]) & (shared != width)
            have[fits] = np.maximum(shared[fits] - 1, 0)
        most = np.minimum(np.minimum(ends[lane] - lane, ends[other] - other), width + 1)
        for step, values in ((8, eight), (1, one)):
            going = np.flatnonzero(have + step <= most)
            while len(going):
                h = have[going]
                going = going[values[lane[going] + h] == values[other[going] + h]]
                have[going] += step
                going = going[have[going] + step <= most[going]]
        common[lane] = have
    return common


class _Array:
    """The distinct strings of one array, sorted, each with its smallest document."""

    def __init__(self, pieces: list[bytes], least: np.ndarray, width: int):
        lengths = np.array([len(p) for p in pieces], np.int64)
        self.text = b"".join(pieces)
        ends = np.cumsum(lengths)
        begins = ends - lengths
        windows = lengths - width + 1
        self.first = np.cumsum(windows) - windows  # place of each piece's first window
        self.windows = windows
        piece = np.repeat(np.arange(len(pieces)), windows)
        offset = np.arange(len(piece)) - self.first[piece]
        starts = begins[piece] + offset
        order = suffix_array(self.text, starts, width)
        stops = np.zeros(len(self.text) + 1, np.int64)
        stops[starts] = ends[piece]
        step = offset % LANES
        by_offset = np.argsort(step, kind="stable")
        cuts = np.flatnonzero(np.diff(step[by_offset])) + 1
        lanes = np.split(starts[by_offset], cuts)
        common = common_prefixes(self.text, order, lanes, stops, width)
        place = np.zeros(len(self.text), np.int64)
        place[starts] = np.arange(len(starts))
        sorted_windows = place[order]
        new = common[order] < width
        new[0] = True
        heads = np.flatnonzero(new)
        self.group = np.empty(len(starts), np.int64)  # of each window
        self.group[sorted_windows] = np.cumsum(new) - 1
        self.least = np.minimum.reduceat(least[piece][sorted_windows], heads)
        raw = np.frombuffer(self.text, np.uint8)
        view = np.lib.stride_tricks.sliding_window_view(raw, width)
        self.head = order[heads]
        self._view = view

    def strings(self) -> np.ndarray:
        width = self._view.shape[1]
        return np.ascontiguousarray(self._view[self.head]).view(f"S{width}").ravel()


def _merge(arrays: list[_Array]) -> None:
    """Every array's smallest documents become those over all arrays."""
    if len(arrays) == 1:
        return
    strings, least = arrays[0].strings(), arrays[0].least
    for array in arrays[1:]:
        mine = array.strings()
        at = np.searchsorted(strings, mine)
        there = np.minimum(at, len(strings) - 1)
        same = strings[there] == mine
        np.minimum.at(least, there[same], array.least[same])
        least = np.insert(least, at[~same], array.least[~same])
        strings = np.insert(strings, at[~same], mine[~same])
    for array in arrays:
        array.least = least[np.searchsorted(strings, array.strings())]


def recurring(pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece, start and stop of the stretches whose every window may be in another place too.

    Windows are told apart by hashes here; equal ones have equal hashes, so none is lost, and a
    chance hit costs a window that the arrays find to be alone.
    """
    lengths = np.array([len(p) for p in pieces], np.int64)
    windows = lengths - width + 1
    first = np.cumsum(windows) - windows
    starts = np.arange(windows.sum()) + np.repeat(np.cumsum(lengths) - lengths - first, windows)
    key = repeats.byte_hashes(b"".join(pieces), width)[starts]
    bits = np.uint64(len(starts).bit_length())
    key = key >> bits << bits | np.arange(len(starts), dtype=np.uint64)
    key.sort()
    equal = (key[1:] ^ key[:-1]) >> bits == 0
    window = (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    again = np.zeros(len(starts), bool)
    again[window[1:][equal]] = True
    again[window[:-1][equal]] = True
    turn = np.diff(again, prepend=False)
    turn[first] = True
    edge = np.flatnonzero(turn)
    last = np.append(edge[1:], len(starts)) - 1
    edge, last = edge[again[edge]], last[again[edge]]
    of = np.searchsorted(first, edge, "right") - 1
    return of, edge - first[of], last - first[of] + width


def kernel(width: int = WIDTH, array_bytes: int = ARRAY_BYTES):
    """Compares a shard's pieces; gives the spans that a document of smaller id has too."""

    def compare(pieces: repeats.Pieces) -> np.ndarray:
        given = repeats.Places.of(pieces.places)
        places, sizes = given.rows, given.sizes
        piece = np.repeat(np.arange(len(sizes)), sizes)  # of each place
        least = np.minimum.reduceat(places[:, 0], np.cumsum(sizes) - sizes)
        least_here = least[piece] == places[:, 0]
        found = [places[~least_here]]  # the same piece is in a smaller document

        of, start, stop = recurring(pieces.texts, width)
        stretches = [pieces.texts[i][x:y] for i, x, y in zip(of.tolist(), start.tolist(), stop.tolist())]
        arrays, cuts = [], [0]
        held = 0
        for i, stretch in enumerate(stretches):
            if held and held + len(stretch) > array_bytes:
                cuts.append(i)
                held = 0
            held += len(stretch)
        cuts.append(len(stretches))
        if stretches:
            arrays = [_Array(stretches[a:b], least[of[a:b]], width) for a, b in zip(cuts, cuts[1:])]
            _merge(arrays)
        places, piece = places[least_here], piece[least_here]
        for array, a, b in zip(arrays, cuts, cuts[1:]):
            stretch = np.repeat(np.arange(a, b), array.windows)
            smaller = array.least[array.group] < least[of[stretch]]  # by window: another document has it
            edge = np.flatnonzero(np.diff(smaller, prepend=False, append=False)
                                  | np.append(np.diff(stretch, prepend=-1) != 0, True))
            first, last = edge[:-1], edge[1:] - 1
            first, last = first[smaller[first]], last[smaller[first]]
            offset = start[stretch[first]] - array.first[stretch[first] - a]
            begin, end = first + offset, last + offset + width
            low = np.searchsorted(piece, of[stretch[first]])
            times = np.searchsorted(piece, of[stretch[first]], "right") - low
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            rows = places[np.repeat(low, times) + nth]
            rows[:, 3] = rows[:, 2] + np.repeat(end, times)
            rows[:, 2] += np.repeat(begin, times)
            found.append(rows)
        return np.concatenate(found)
    return compare


def repeated(rows: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    return repeats.repeated_spans(rows, repeats.Unit(width, gram), kernel(width))


def deduplicated(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every document."""
    rows = repeats.keyed(docs)

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            keys = batch.column(batch.schema.get_field_index("k")).to_pylist()
            for key, text, spans in zip(keys, texts(batch).to_pylist(), repeats.merged(batch)):
                digest = hashlib.sha256()
                for part in repeats.kept(text, spans):
                    digest.update(part)
                out.append((None if key == repeats.NO_ID else key, len(text),
                            sum(b - a for a, b in spans), len(spans), digest.hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in list(zip(*out))[:4]]
                + [pa.array([x[4] for x in out], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.join(repeated(rows, width, gram), "k", "left").mapInArrow(
        finish, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def _whole_characters(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without characters that they hold in part."""
    out = []
    for a, b in spans:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while a < b and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def without_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """The documents with their repeats cut out; a character that is repeated in part stays.

    Columns as in ``docs``; n_chars, if there, is the new text's length. A null text stays null.
    """
    schema = docs.schema
    rows = repeats.keyed(docs)
    tagged = docs.select(F.struct("*").alias("row"), *[
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(repeats.NO_ID)).alias("k"),
        F.hash("text").alias("tag"), "text"])

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, spans in zip(texts(batch).to_pylist(), repeats.merged(batch)):
                spans = _whole_characters(text, spans)
                out.append(b"".join(repeats.kept(text, spans)).decode())
            rows_ = batch.column(batch.schema.get_field_index("row"))
            yield pa.RecordBatch.from_arrays([rows_, pa.array(out, pa.string())], ["row", "cut"])

    found = tagged.join(repeated(rows, width, gram), "k", "left").mapInArrow(
        finish, StructType([StructField("row", schema), StructField("cut", StringType())]))
    text = F.when(F.col("row.text").isNotNull(), F.col("cut"))
    columns = {name: F.col("row").getField(name) for name in schema.names}
    columns["text"] = text
    if "n_chars" in columns:
        columns["n_chars"] = F.length(text).cast(schema["n_chars"].dataType)
    return found.select(*[c.alias(name) for name, c in columns.items()])
