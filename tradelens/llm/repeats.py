"""Where documents can repeat each other: the way from texts to comparable pieces and back.

A window is ``width`` consecutive symbols (bytes or words) of one text. Its anchor is the smallest
hash among its ``gram``-symbol grams, so equal windows have equal anchors, and consecutive windows
mostly share theirs: a text falls into runs of windows with one anchor, about one run for every
(width - gram) / 2 symbols. That makes repeated windows comparable without moving all windows:

1. ``live_anchors``: the anchors that occur in two places, from packed hashes only;
2. ``pieces``: for runs with such an anchor, the symbols of the run, sent to the anchor's shard;
3. a shard kernel (suffix arrays in ``suffix``, automata in ``phrases``) compares whole pieces and
   returns the spans that repeat;
4. ``cut``: spans joined to the texts.

Every slice of documents first settles what it can by itself: of equal anchors it sends one, of
equal pieces one, so a piece that a third of all documents share reaches its shard once per slice.
Texts are shuffled once; both joins use the same exchange.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelens.llm.text import bounded_batches, shards_for, slices, texts

_ODD = np.uint64(0x9E3779B97F4A7C15)
_HALF = np.uint64(32)
_CODE_BITS = np.uint64(40)
_STRETCH = 1 << 14  # places hashed at a time: their numbers stay in a core's cache
NO_ID = (1 << 63) - 1  # stands for a null doc_id: larger than every other


@dataclass(frozen=True)
class Unit:
    """What a text is made of, and the windows looked for."""

    width: int
    gram: int
    words: bool = False
    same_document: bool = False  # whether two places in one document count

    def symbols(self, text: bytes) -> bytes | list[bytes]:
        return text.split() if self.words else text

    def joined(self, symbols: Iterable[bytes | list[bytes]]) -> list[bytes]:
        return [b" ".join(words) for words in symbols] if self.words else list(symbols)


def mix(x: np.ndarray) -> np.ndarray:
    x = x * _ODD
    x ^= x >> _HALF
    return x


def _mix_here(x: np.ndarray, spare: np.ndarray) -> None:
    """``mix`` in place; ``spare`` is as long and loses what it holds."""
    x *= _ODD
    np.right_shift(x, _HALF, out=spare)
    x ^= spare


def rolled(h: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of ``gram`` symbols in a row, from those of single symbols; runs out at the end."""
    reach = 1
    while reach < gram:
        step = min(reach, gram - reach)
        out = h * _ODD
        out[:len(h) - step] += h[step:]
        h = mix(out)
        reach += step
    return h


def eight_bytes(text: bytes, kind: str) -> np.ndarray:
    """The number that the eight bytes at each place make; zeros follow the text."""
    out = np.empty(len(text) + 1, kind)
    padded = text + bytes(16)
    for o in range(8):
        part = out[o::8]
        part[:] = np.frombuffer(padded, kind, len(part), o)
    return out


def _gram_hashes(unit: Unit, symbols: list[bytes | list[bytes]]) -> np.ndarray:
    """The hash of the gram starting at each symbol of all texts on end."""
    if unit.words:
        flat = [w for words in symbols for w in words]
        h = mix(np.fromiter(map(zlib.crc32, flat), np.uint64, len(flat)) + np.uint64(1))
        return rolled(h, unit.gram)
    return byte_hashes(b"".join(symbols), unit.gram)


def byte_hashes(text: bytes, width: int) -> np.ndarray:
    """The hash of the ``width`` bytes (8 or more) from each place on; zeros follow the text."""
    out = np.empty(len(text), np.uint64)
    for a in range(0, len(text), _STRETCH):
        wanted = out[a:a + _STRETCH]
        part = text[a:a + len(wanted) + width].ljust(len(wanted) + width, b"\0")
        h = eight_bytes(part, "<u8").astype(np.uint64, copy=False)
        spare = np.empty_like(h)
        _mix_here(h, spare)
        reach = 8
        while reach < width:  # a last step that overlaps reaches any width
            step = min(reach, width - reach)
            np.multiply(h[:-step], _ODD, out=spare[:-step])
            spare[:-step] += h[step:]
            h, spare = spare, h
            _mix_here(h, spare)
            reach += step
        wanted[:] = h[:len(wanted)]
    return out


def _sliding_min(h: np.ndarray, span: int) -> np.ndarray:
    out = np.empty(max(len(h) - span + 1, 0), h.dtype)
    for a in range(0, len(out), _STRETCH):
        part = h[a:a + _STRETCH + span - 1]
        reach = 1
        while reach < span:
            step = min(reach, span - reach)
            part = np.minimum(part[:len(part) - step], part[step:])
            reach += step
        out[a:a + _STRETCH] = part
    return out


@dataclass
class Runs:
    doc: np.ndarray  # place of the text in the slice
    start: np.ndarray  # first window, as a symbol of the text
    stop: np.ndarray  # after the last window's last symbol
    anchor: np.ndarray


def runs(unit: Unit, symbols: list[bytes | list[bytes]]) -> Runs:
    lengths = np.array([len(s) for s in symbols], np.int64)
    total = int(lengths.sum())
    none = np.zeros(0, np.int64)
    if total < unit.width:
        return Runs(none, none, none, none.astype(np.uint64))
    ends = np.cumsum(lengths)
    hashes = _gram_hashes(unit, symbols)
    least = _sliding_min(hashes, unit.width - unit.gram + 1)[:total - unit.width + 1]
    turn = np.empty(len(least), bool)
    np.not_equal(least[1:], least[:-1], out=turn[1:])
    if unit.same_document:  # a gram that comes twice in a row of windows makes two runs
        turn[1:] |= hashes[:len(least) - 1] == least[:-1]
    begins = ends - lengths
    for edge in (begins, (ends - unit.width + 1)[lengths >= unit.width]):
        turn[edge[edge < len(least)]] = True  # no window reaches into the next text
    first = np.flatnonzero(turn)
    last = np.append(first[1:], len(least)) - 1
    doc = np.searchsorted(ends, first, "right")
    keep = first + unit.width <= ends[doc]
    doc, first, last = doc[keep], first[keep], last[keep]
    return Runs(doc, first - begins[doc], last - begins[doc] + unit.width, mix(least[first]))


def codes(anchors: np.ndarray, shards: int) -> np.ndarray:
    """shard << 40 | 40 bits of the anchor's hash; sorted codes are sorted by shard."""
    shard = ((anchors >> _HALF) * np.uint64(shards)) >> _HALF
    return (shard << _CODE_BITS) | (mix(anchors) >> np.uint64(24))


def pack(values: np.ndarray) -> bytes:
    """Byte planes of what values exceed the smallest by: high bytes, mostly zero, lie together."""
    if not len(values):
        return b""
    values = values.astype(np.uint64)
    least = values.min()
    return least.tobytes() + (values - least).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(data, np.uint8, offset=8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel() + np.frombuffer(data, np.uint64, 1)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values.astype(np.uint64), prepend=values[:1].astype(np.uint64))) \
        + values[:1].astype(np.uint64).tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data[:-8]), dtype=np.uint64) + np.frombuffer(data[-8:], np.uint64)


def short(code: np.ndarray) -> np.ndarray:
    """Half a code, with which a document finds its live anchors again; a chance hit costs a piece
    that turns out not to repeat."""
    return mix(code).view(np.uint32)[1::2].view(np.int32)


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("k")).to_numpy(zero_copy_only=False)


def _by_shard(of: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal shards in codes that are sorted."""
    shard = (of >> _CODE_BITS).astype(np.int64)
    edges = np.flatnonzero(np.diff(shard, prepend=-1))
    for a, b in zip(edges, np.append(edges[1:], len(shard))):
        yield int(shard[a]), slice(a, b)


# --- anchors that occur twice

_SENT = "shard int, known boolean, keys binary, codes binary"


def _send_anchors(unit: Unit, shards: int) -> Callable:
    names = ["shard", "known", "keys", "codes"]

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys = _keys(batch)
            found = runs(unit, [unit.symbols(t) for t in texts(batch).to_pylist()])
            if not len(found.doc):
                continue
            code = codes(found.anchor, shards)
            order = np.argsort(code)
            code = code[order]
            new = np.append(True, code[1:] != code[:-1])
            again = np.flatnonzero(~(new & np.append(new[1:], True)))  # anchors found twice or more
            ids, rank = np.unique(keys, return_inverse=True)
            rank = rank[found.doc[order]]
            both = np.cumsum(new[again]) << 32 | rank[again]
            both.sort()
            rank[again] = both & ((1 << 32) - 1)
            key = ids[rank]
            if not unit.same_document:  # one entry for each anchor and document
                keep = new | np.append(True, key[1:] != key[:-1])
                code, key, new = code[keep], key[keep], new[keep]
            first = np.flatnonzero(new)
            often = np.diff(np.append(first, len(code))) > 1
            known = np.repeat(often, np.diff(np.append(first, len(code))))
            one_key, one_code = key[first], code[first]
            rows = [(s, False, pack(one_key[part]), pack_sorted(one_code[part]))
                    for s, part in _by_shard(one_code)]
            if known.any():  # settled here; any shard may pass them on
                rows.append((int(code[0] % np.uint64(shards)), True, pack(key[known]),
                             pack_sorted(code[known])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.bool_(), pa.binary(),
                                                             pa.binary()))], names)
    return send


def _meet_anchors(unit: Unit) -> Callable:
    def meet(group: pa.Table) -> pa.Table:
        sent = group.to_pydict()
        keys = [unpack(x).astype(np.int64) for x in sent["keys"]]
        code = [unpack_sorted(x) for x in sent["codes"]]
        known = [np.full(len(c), x) for c, x in zip(code, sent["known"])]
        key, code, known = np.concatenate(keys), np.concatenate(code), np.concatenate(known)
        live_keys, live_codes = [key[known]], [code[known]]
        key, code = key[~known], code[~known]
        if len(code):
            order = np.argsort(code)
            key, code = key[order], code[order]
            first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            size = np.diff(np.append(first, len(code)))
            if unit.same_document:
                live = size > 1
            else:
                live = np.minimum.reduceat(key, first) != np.maximum.reduceat(key, first)
            live = np.repeat(live, size)
            live_keys.append(key[live])
            live_codes.append(code[live])
        return pa.table({"k": pa.array(np.concatenate(live_keys), pa.int64()),
                         "code": pa.array(short(np.concatenate(live_codes)), pa.int32())})
    return meet


def keyed(docs: DataFrame) -> DataFrame:
    """k (doc_id, or the largest number for null), tag (tells texts of one id apart), text."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("k"),
        F.hash("text").alias("tag"), "text")


def live_anchors(rows: DataFrame, unit: Unit, shards: int) -> DataFrame:
    """k, codes: for each document the anchors that occur in another place too."""
    sent = rows.select("k", "text").mapInArrow(_send_anchors(unit, shards), _SENT)
    live = sent.groupBy("shard").applyInArrow(_meet_anchors(unit), "k bigint, code int")
    return live.groupBy("k").agg(F.collect_set("code").alias("codes"))


# --- pieces

_PIECES = ("shard int, known boolean, keys binary, tags binary, starts binary, stops binary, "
           "weights binary, lengths binary, data binary")
_FIELDS = ["keys", "tags", "starts", "stops", "weights", "lengths"]


def joined(spans: np.ndarray) -> np.ndarray:
    """Rows key, tag, start, stop: sorted, what overlaps or touches in one text made one span."""
    key, tag, start, stop = spans[:, np.lexsort(spans[2::-1])]
    text = np.cumsum(np.append(False, (np.diff(key) != 0) | (np.diff(tag) != 0))) << 32
    far = np.maximum.accumulate(text + stop)
    first = np.flatnonzero(np.append(True, (text + start)[1:] > far[:-1]))
    last = np.append(first[1:], len(key)) - 1
    return np.stack([key[first], tag[first], start[first], far[last] - text[last]])


def _piece_row(shard: int, known: bool, columns: Iterable[np.ndarray], data: bytes,
               zstd: zstandard.ZstdCompressor) -> dict:
    """columns: key, tag, start, stop, weight, bytes in data."""
    return {"shard": shard, "known": known, "data": zstd.compress(data)} | {
        name: pack(c) for name, c in zip(_FIELDS, columns)}


def _settle(unit: Unit, pieces: list[bytes], keys: np.ndarray, maybe: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What a slice can say of its pieces that are equal; only those of ``maybe`` are compared.

    Gives the places to send, those of one piece in a row, which of them come with the piece's data,
    how many places each stands for (two for more), and the places that are known to repeat.
    """
    sent, leader = np.ones(len(pieces), bool), np.arange(len(pieces))
    weight, known = np.ones(len(pieces), np.int64), np.zeros(len(pieces), bool)
    same: dict[bytes, list[int]] = {}
    for i in maybe.tolist():
        same.setdefault(pieces[i], []).append(i)
    for places in same.values():
        if len(places) == 1:
            continue
        if unit.same_document:
            known[places] = True
            sent[places[1:]] = False
            weight[places[0]] = 2
        else:
            key = keys[places]
            least = key == key.min()
            places = np.array(places)
            known[places[~least]] = True
            sent[places[~least]] = False
            leader[places[least]] = places[least][0]
    sent = np.flatnonzero(sent)
    sent = sent[np.argsort(leader[sent], kind="stable")]
    return sent, leader[sent] == sent, weight[sent], np.flatnonzero(known)


def _send_pieces(unit: Unit, shards: int) -> Callable:
    schema = pa.schema([("shard", pa.int32()), ("known", pa.bool_())]
                       + [(name, pa.binary()) for name in (*_FIELDS, "data")])

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches):
            symbols = [unit.symbols(t) for t in texts(batch).to_pylist()]
            found = runs(unit, symbols)
            live = np.unique(batch.column(batch.schema.get_field_index("codes")).flatten()
                             .to_numpy(zero_copy_only=False))
            code = codes(found.anchor, shards)
            if not len(live) or not len(code):
                continue
            half = short(code)
            at = np.minimum(np.searchsorted(live, half), len(live) - 1)
            hit = np.flatnonzero(live[at] == half)
            if not len(hit):
                continue
            hit = hit[np.argsort(code[hit])]
            code, doc, start, stop = code[hit], found.doc[hit], found.start[hit], found.stop[hit]
            pieces = unit.joined(symbols[d][a:b] for d, a, b in
                                 zip(doc.tolist(), start.tolist(), stop.tolist()))
            tags = batch.column(batch.schema.get_field_index("tag")).to_numpy()
            places = np.stack([_keys(batch)[doc], tags.astype(np.int64)[doc], start, stop])
            again = code[1:] == code[:-1]
            maybe = np.flatnonzero(np.append(again, False) | np.append(False, again))
            sent, full, weight, known = _settle(unit, pieces, places[0], maybe)
            pieces = [pieces[i] for i in sent.tolist()]
            lengths = np.where(full, np.fromiter(map(len, pieces), np.int64, len(pieces)), 0)
            columns = np.vstack([places[:, sent], weight, lengths])
            data = [p if f else b"" for p, f in zip(pieces, full.tolist())]
            rows = [_piece_row(s, False, columns[:, part], b"".join(data[part]), zstd)
                    for s, part in _by_shard(code[sent])]
            if len(known):  # settled here; any shard may pass them on
                settled = joined(places[:, known])
                settled = np.vstack([settled, np.zeros((2, settled.shape[1]), np.int64)])
                rows.append(_piece_row(int(found.anchor[0] % np.uint64(shards)), True, settled, b"", zstd))
            yield pa.RecordBatch.from_pylist(rows, schema)
    return send


class Places:
    """The places of pieces, as rows key, tag, start, stop; goes through them piece by piece."""

    def __init__(self, rows: np.ndarray, sizes: np.ndarray):
        self.rows, self.sizes = rows, sizes  # sizes: how many places each piece has

    @classmethod
    def of(cls, places: Places | list[list[tuple[int, int, int, int]]]) -> Places:
        if isinstance(places, cls):
            return places
        return cls(np.array([p for each in places for p in each], np.int64),
                   np.array([len(each) for each in places], np.int64))

    def __iter__(self) -> Iterator[list[list[int]]]:
        ends = np.cumsum(self.sizes).tolist()
        return (self.rows[a:b].tolist() for a, b in zip([0, *ends], ends))


@dataclass
class Pieces:
    """What a shard has to compare: the distinct pieces, and for each the places it was sent from."""

    texts: list[bytes]
    places: Places | list[list[tuple[int, int, int, int]]]  # key, tag, start, stop
    weights: list[int]  # how many places it has, two standing for more


def _received(group: pa.Table) -> tuple[Pieces, list[np.ndarray]]:
    number: dict[bytes, int] = {}
    zstd = zstandard.ZstdDecompressor()
    of, places, known = [], [], []
    for row in group.to_pylist():
        fields = np.stack([unpack(row[name]).astype(np.int64) for name in _FIELDS])
        if row["known"]:
            known.append(fields[:4])
            continue
        data, full = zstd.decompress(row["data"]), fields[5] > 0
        ends = np.cumsum(fields[5][full]).tolist()
        mine = np.array([number.setdefault(data[a:b], len(number)) for a, b in zip([0, *ends], ends)],
                        np.int64)
        of.append(mine[np.cumsum(full) - 1])  # the others are more places of the piece before
        places.append(fields[:5])
    if not of:
        return Pieces([], [], []), known
    piece, rows = np.concatenate(of), np.hstack(places)
    sizes = np.bincount(piece)
    weights = np.bincount(piece, rows[4]).astype(np.int64).tolist()
    rows = np.ascontiguousarray(rows[:4, np.argsort(piece, kind="stable")].T)
    return Pieces(list(number), Places(rows, sizes), weights), known


def _meet_pieces(kernel: Callable[[Pieces], Iterator[tuple[int, int, int, int]]]) -> Callable:
    def meet(group: pa.Table) -> pa.Table:
        pieces, spans = _received(group)
        if pieces.texts:
            found = kernel(pieces)
            if not isinstance(found, np.ndarray):
                found = np.array(list(found), np.int64).reshape(-1, 4)
            spans.append(found.T)
        both = np.hstack(spans) if spans else np.zeros((4, 0), np.int64)
        key, tag, start, stop = joined(both) if both.shape[1] else both
        return pa.table({"k": pa.array(key, pa.int64()), "tag": pa.array(tag, pa.int32()),
                         "start": pa.array(start, pa.int32()), "stop": pa.array(stop, pa.int32())})
    return meet


def repeated_spans(rows: DataFrame, unit: Unit,
                   kernel: Callable[[Pieces], Iterator[tuple[int, int, int, int]]],
                   shards: int | None = None) -> DataFrame:
    """k, spans (tag, start, stop): what ``kernel`` finds repeated, for documents ``keyed``."""
    bounded_batches(rows.sparkSession)
    shards = shards or shards_for(rows)
    live = live_anchors(rows, unit, shards)
    sent = rows.join(live, "k").mapInArrow(_send_pieces(unit, shards), _PIECES)
    spans = sent.groupBy("shard").applyInArrow(
        _meet_pieces(kernel), "k bigint, tag int, start int, stop int")
    return spans.groupBy("k").agg(F.collect_list(F.struct("tag", "start", "stop")).alias("spans"))


# --- back to the texts

def merged(batch: pa.RecordBatch) -> list[list[tuple[int, int]]]:
    """For each text, by the columns tag and spans, the maximal runs of its spans, in order."""
    spans, tags = (batch.column(batch.schema.get_field_index(name)) for name in ("spans", "tag"))
    text = np.repeat(np.arange(len(spans)), pc.list_value_length(spans).fill_null(0).to_numpy())
    tag, start, stop = (field.to_numpy().astype(np.int64) for field in spans.flatten().flatten())
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(spans))]
    mine = np.stack([text, tag, start, stop])[:, tag == tags.to_numpy()[text]]
    if mine.shape[1]:
        text, _, start, stop = joined(mine).tolist()
        for i, a, b in zip(text, start, stop):
            out[i].append((a, b))
    return out


def kept(symbols: bytes | list[bytes], spans: list[tuple[int, int]]) -> list:
    """The parts of ``symbols`` outside of ``spans``."""
    edges = [0, *(x for span in spans for x in span), len(symbols)]
    return [symbols[a:b] for a, b in zip(edges[::2], edges[1::2])]
