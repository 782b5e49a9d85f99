"""Token ids by public tokenizers, each distinct piece of text encoded once."""

from __future__ import annotations

import ctypes
import gc
import json
import os
import re
import sys
import types
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, repeat
from pathlib import Path

import numpy as np

KEPT, KEPT_CHARS = 200_000, 8 << 20  # what a worker remembers from slice to slice
KEPT_WORDS = 800_000  # of words, which take less room


def vocabulary_bytes(path: str | None, name: str) -> bytes:
    """A vocabulary file, read on the driver; a few MB, sent to the executors as they are."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(name)
    return Path(path).read_bytes()


def merges(data: bytes):
    """A tokenizer of the tokenizers library that takes special tokens' strings for plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    found = Tokenizer.from_buffer(data)
    found.encode_special_tokens = True
    return found


def per_worker(name: str, files: list[bytes], make: Callable[[], object]):
    """What ``make`` gives, made once for a worker process and these files; only the last is kept.

    Functions travel to the executors by value, with globals of their own for each task, so a module
    that lives in the process holds it.
    """
    shelf = sys.modules.setdefault("_tradelens_shelf", types.ModuleType("_tradelens_shelf"))
    key = (name, *(zlib.crc32(f) for f in files), *map(len, files))
    if getattr(shelf, "key", None) != key:
        shelf.key = shelf.held = None
        shelf.held = make()
        shelf.key = key
    return shelf.held


def forget_worker() -> None:
    """Let go of what ``per_worker`` holds, in a stage that has no use for it, and of its memory."""
    shelf = sys.modules.get("_tradelens_shelf")
    if getattr(shelf, "held", None) is not None:
        shelf.key = shelf.held = None
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps what is freed otherwise
        if trim:
            trim(0)


def byte_characters() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte.

    Printable Latin-1 bytes stand for themselves, the others take the code points from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def looked_up(known: dict[str, int], pieces: list[str], learn: Callable[[list[str]], None]) -> np.ndarray:
    """The number of every piece; ``learn`` gets those not known, once each, and makes them known."""
    numbers = np.fromiter(map(known.get, pieces, repeat(-1)), np.int64, len(pieces))
    missing = np.flatnonzero(numbers < 0).tolist()
    if missing:
        new = [pieces[i] for i in missing]
        learn(list(dict.fromkeys(new)))
        numbers[missing] = [known[p] for p in new]
    return numbers


class Memory:
    """Ids of pieces by ``encode``, which is asked once for each piece that is remembered.

    Bounded: a call that finds more than ``kept`` pieces or ``KEPT_CHARS`` characters forgets them.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], kept: int):
        self._encode, self._kept = encode, kept
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._flat, self._ptr, self._chars = np.empty(0, np.int64), np.zeros(1, np.int64), 0

    def _learn(self, new: list[str]) -> None:
        found = self._encode(new)
        sizes = [len(i) for i in found]
        flat = np.fromiter(chain.from_iterable(found), np.int64, sum(sizes))
        self._ptr = np.append(self._ptr, self._ptr[-1] + np.cumsum(sizes))
        self._flat = np.append(self._flat, flat)
        self._chars += sum(map(len, new))
        self._known.update(zip(new, range(len(self._known), len(self._known) + len(new))))

    def ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids known, where each piece's ids start and end, and the number of every given piece."""
        if len(self._known) > self._kept or self._chars > KEPT_CHARS:
            self._forget()
        numbers = looked_up(self._known, pieces, self._learn)
        return self._flat, self._ptr, numbers


def spread(flat: np.ndarray, ptr: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the chosen pieces one after the other, and where each one's start and end."""
    size = np.diff(ptr)[chosen]
    out = np.append(0, np.cumsum(size))
    return flat[np.repeat(ptr[chosen] - out[:-1], size) + np.arange(out[-1])], out


# --- fixed values: how the word vocabulary's file cuts a text before its merges ---
LOWER_WORDS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
WORD = re.compile(r"[^ \t\n\r]+")
# Of these characters it is known what normalising, lower case and the cut make of them.
PLAIN = re.compile(r"[ \t\n\r!-~À-ÖØ-öø-ÿ]*")
JOINED = 100  # pieces that the tokenizer gets in one call
PART = re.compile(r"[a-zß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^a-z0-9ß-öø-ÿ \t\n\r]+")
WHOLE = "\0"  # marks a piece that the tokenizer itself must cut


class Words:
    """Ids of texts by a tokenizer that works word by word in lower case.

    Texts of plain characters are cut here, and only the merges are left to the tokenizer, once for
    each distinct piece. Other words go through it as they are, and so do whole texts if the file
    prescribes other steps than ``LOWER_WORDS``.
    """

    def __init__(self, data: bytes):
        self._known = merges(data)
        self.size = self._known.get_vocab_size(with_added_tokens=True)
        file = json.loads(data)
        self._by_word = all(file[key] == value for key, value in LOWER_WORDS.items())
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self._bare = type(self._known)(self._known.model)
        self._bare.pre_tokenizer = WhitespaceSplit()  # between the pieces of a call
        written = {b: c for c, b in byte_characters().items()}
        self._letters = {c: "".join(written[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}
        self._memory = Memory(self._encode, KEPT_WORDS)

    def _encode(self, pieces: list[str]) -> list[list[int]]:
        plain = [p for p in pieces if p[0] != WHOLE]
        other = [p[1:] for p in pieces if p[0] == WHOLE]
        found = self._merged(plain)
        rest = iter(self._known.encode_batch_fast(other, add_special_tokens=False))
        return [next(rest).ids if p[0] == WHOLE else next(found) for p in pieces]

    def _merged(self, plain: list[str]) -> Iterator[list[int]]:
        """Ids of plain pieces, which hold no white space, also not as a byte-level vocabulary writes them."""
        for first in range(0, len(plain), JOINED):
            part = plain[first:first + JOINED]
            text = " ".join(part)
            found = self._bare.encode(text if text.isascii() else text.translate(self._letters),
                                      add_special_tokens=False)
            ids, of = found.ids, found.word_ids
            end = 0
            for number in range(len(part)):
                begin = end
                while end < len(of) and of[end] == number:
                    end += 1
                yield ids[begin:end]

    def _cut(self, text: str) -> list[str]:
        if not self._by_word:
            return [WHOLE + text] if text else []
        if PLAIN.fullmatch(text):
            return PART.findall(text.lower())
        out: list[str] = []
        for word in WORD.findall(text):
            out += PART.findall(word.lower()) if PLAIN.fullmatch(word) else [WHOLE + word]
        return out

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids in a row, and where each text's ids start and end."""
        pieces, ends = [], [0]
        for text in texts:
            pieces += self._cut(text)
            ends.append(len(pieces))
        flat, at = spread(*self._memory.ids(pieces))
        return flat, at[ends]
