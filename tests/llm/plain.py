"""The operators' results by plain loops, and documents with everything that may go wrong."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

NO_ID = (1 << 63) - 1
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def spaced(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def by_text(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=str)


def base(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    triples = Counter(zip(words, words[1:], words[2:]))
    marked = {i + k for i in range(len(words) - 2) for k in range(3)
              if triples[tuple(words[i:i + 3])] > 1}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(marked))


def byte_repeats(rows: list[tuple], width: int = 50) -> list[tuple[bytes, bytearray]]:
    """Every text and, for each byte, whether it goes."""
    rows = [(NO_ID if d is None else d, (t or "").encode()) for d, t in rows]
    first: dict[bytes, int] = {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        for i in range(len(t) - width + 1):
            first.setdefault(t[i:i + width], d)
    out = []
    for d, t in rows:
        gone = bytearray(len(t))
        for i in range(len(t) - width + 1):
            if first[t[i:i + width]] < d:
                gone[i:i + width] = b"\1" * width
        out.append((t, gone))
    return out


def suffix_dedup(rows: list[tuple], width: int = 50) -> list[tuple]:
    out = []
    for (d, _), (t, gone) in zip(rows, byte_repeats(rows, width)):
        left = bytes(c for c, x in zip(t, gone) if not x)
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return by_text(out)


def without_repeats(rows: list[tuple], width: int = 50) -> list[str | None]:
    out = []
    for (_, text), (_, gone) in zip(rows, byte_repeats(rows, width)):
        if text is None:
            out.append(None)
            continue
        at, left = 0, []
        for c in text:
            n = len(c.encode())
            left.append("" if all(gone[at:at + n]) else c)
            at += n
        out.append("".join(left))
    return out


def phrase_dedup(rows: list[tuple], width: int = 35) -> list[tuple]:
    held = [(d, spaced(t)) for d, t in rows]
    seen = Counter(tuple(w[i:i + width]) for _, w in held for i in range(len(w) - width + 1))
    out = []
    for d, w in held:
        gone = {i + k for i in range(len(w) - width + 1) for k in range(width)
                if seen[tuple(w[i:i + width])] > 1}
        left = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(left)).hexdigest()))
    return by_text(out)


def shingles(text: str | None, width: int = 2) -> frozenset:
    words = spaced(re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def near_dups(rows: list[tuple], least: int = 80, width: int = 2) -> list[tuple]:
    """doc_id, set size, smallest reachable doc_id, kept; unique doc_ids only."""
    sets = {d: shingles(t, width) for d, t in rows if d is not None}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if 100 * common >= least * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return by_text([(d, len(shingles(t, width)), None if d is None else find(d), d is None or find(d) == d)
                    for d, t in rows])


def odd_documents(seed: int = 5, n: int = 60, ids: str = "odd") -> list[tuple]:
    """Copies, near copies, shared passages, nulls, empty and long texts, repeated rows and ids."""
    rng = random.Random(seed)
    pool = ["the", "of", "Größe", "naïve", "x", "a", "#1", "|", "résumé", "MIT", "License", "12",
            "und", "el", "niño", "tion", "ing", "日本"] + [f"w{i}" for i in range(40)]
    bases = [[rng.choice(pool) for _ in range(rng.randint(90, 160))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        kind = i % 10
        if kind == 0:
            text = None
        elif kind == 1:
            text = rng.choice(["", " ", "\n\n", "word", "two words", "é" * 70, "ab " * 80])
        elif kind in (2, 3):
            text = " ".join(words)
        elif kind in (4, 5, 6):
            for _ in range(rng.randint(1, 12)):
                words[rng.randrange(len(words))] = rng.choice(pool)
            text = rng.choice([" ", "\n", " \t"]).join(words)
        elif kind == 7:
            a = rng.randrange(40)
            text = f"new {i} start " + " ".join(words[a:a + 45]) + f" and end {i}"
        elif kind == 8:
            text = " ".join(rng.choice(pool) for _ in range(3000))
        else:
            text = rows[-1][1]
        doc_id = i * 3 if ids == "unique" else rng.choice([i, i, i, 7, None])
        rows.append((doc_id, text, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "é", None]),
                     len(text or "")))
    return rows + ([] if ids == "unique" else rows[3:6])
