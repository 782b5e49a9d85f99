"""Licence scans by a generalised suffix automaton.

The automaton of all templates' words holds every stretch of words of every template. A text is
streamed through it once; at each word it tells the longest stretch of a template that ends there
(matching statistics). Long matches that cannot be extended are chained, for each template, in the
order of both text and template with small gaps; a chain that covers enough of the template gives the
template's label and a span of the text. What lies before and after a span is chained again, so a text
that holds a notice several times has a span for each. Short phrases are templates of their own, found wherever a
match that ends at their last word is as long as they are.

The automaton is built from a fixed list of templates, so its size is given; documents are streamed
where they lie and not shuffled.

Defined cases: null and empty texts have no words, no labels and score 0. Every row is scanned on its
own, whatever its doc_id. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradelens.llm.text import bounded_batches, slices, texts

# Phrases and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"),
           ("cc by", "cc-by"), ("mit license", "mit"))

# The wording of common notices, by label.
TEMPLATES = (
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this
     software and associated documentation files (the "Software"), to deal in the Software without
     restriction, including without limitation the rights to use, copy, modify, merge, publish,
     distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
     Software is furnished to do so, subject to the following conditions: The above copyright notice
     and this permission notice shall be included in all copies or substantial portions of the
     Software."""),
    ("mit", "Released under the MIT License."),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are
     permitted provided that the following conditions are met: Redistributions of source code must
     retain the above copyright notice, this list of conditions and the following disclaimer.
     Redistributions in binary form must reproduce the above copyright notice, this list of conditions
     and the following disclaimer in the documentation and/or other materials provided with the
     distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with
     or without fee is hereby granted, provided that the above copyright notice and this permission
     notice appear in all copies."""),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
     file except in compliance with the License. You may obtain a copy of the License at
     http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
     writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
     WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
     language governing permissions and limitations under the License."""),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms
     of the GNU General Public License as published by the Free Software Foundation, either version 3
     of the License, or (at your option) any later version. This program is distributed in the hope
     that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
     MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
     details."""),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If
     a copy of the MPL was not distributed with this file, You can obtain one at
     http://mozilla.org/MPL/2.0/."""),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0
     International License."""),
)

LEAST_MATCH, MOST_GAP, LEAST_COVER = 4, 20, 0.6

_FOLD = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c > 127 else c + 32 if 65 <= c < 91 else 32
              for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs of ASCII letters and digits and of all characters beyond ASCII."""
    return text.translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton of word sequences."""

    def __init__(self, templates: Sequence[list[bytes]]):
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = [[self.words.setdefault(w, len(self.words)) for w in t] for t in templates]
        for sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        # Where each state's stretches end, as (template, place), and the templates that are whole.
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.next]
        self.whole: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for number, sequence in enumerate(sequences):
            state = 0
            for place, word in enumerate(sequence):
                state = self.next[state][word]
                self.ends[state].append((number, place + 1))
            self.whole[state].append((number, len(sequence)))
        deepest = sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True)
        for state in deepest:  # a stretch ends wherever a longer one with it as its end does
            self.ends[self.link[state]] += self.ends[state]
        for state in reversed(deepest):
            self.whole[state] = self.whole[state] + self.whole[self.link[state]]
        self.ends = [sorted(set(e)) for e in self.ends]

    def _split(self, state: int, over: int, word: int) -> int:
        """A copy of ``over`` for its stretches no longer than one word more than ``state``'s."""
        self.next.append(dict(self.next[over]))
        self.link.append(self.link[over])
        self.length.append(self.length[state] + 1)
        copy = len(self.next) - 1
        self.link[over] = copy
        while state >= 0 and self.next[state].get(word) == over:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        there = self.next[last].get(word)
        if there is not None:  # another template has it already
            return there if self.length[there] == self.length[last] + 1 \
                else self._split(last, there, word)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        new, state = len(self.next) - 1, last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            over = self.next[state][word]
            self.link[new] = over if self.length[over] == self.length[state] + 1 \
                else self._split(state, over, word)
        return new

    def statistics(self, text: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(words so far, state, length of the longest stretch ending there), where two or more."""
        number = self.words.get
        ids = np.array([number(w, -1) for w in text], np.int64)
        edges = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False]))))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a < 2:
                continue
            state = length = 0
            for i, word in enumerate(ids[a:b].tolist(), a + 1):
                while state and word not in self.next[state]:
                    state = self.link[state]
                    length = self.length[state]
                state = self.next[state].get(word, 0)
                length = length + 1 if state else 0
                if length > 1:
                    yield i, state, length


def _best(found: list[tuple[int, int, int, int]], lo: int, most_gap: int, reach: int,
          enough: float) -> tuple[int, int, int]:
    """The best chain of sorted matches from ``lo`` on; the first that covers ``enough`` ends the search.

    Of chains with equal cover up to a match the shortest counts, so none takes in another notice.
    """
    best: list[tuple[int, int]] = []  # covered words up to and with each match, first word
    top = (0, 0, 0)
    for i in range(lo, len(found)):
        a, b, x, y = found[i]
        mine = (y - x, a)
        for j in range(i - 1, lo - 1, -1):
            a2, b2, x2, y2 = found[j]
            if a - a2 > reach:
                break
            if b2 <= b and y2 < y and x2 <= x and a - b2 <= most_gap and x - y2 <= most_gap:
                mine = max(mine, (best[j - lo][0] + min(y - x, y - y2), best[j - lo][1]))
        best.append(mine)
        if mine[0] > top[0]:
            top = (mine[0], mine[1], b)
            if mine[0] >= enough:
                break
    return top


def _reach(found: list[tuple[int, int, int, int]], most_gap: int) -> int:
    return most_gap + max(e[1] - e[0] for e in found)


def chains(found: list[tuple[int, int, int, int]], most_gap: int = MOST_GAP) -> tuple[int, int, int]:
    """The best chain of one template's matches (start, end in the text; start, end in the template).

    Returns covered template words, and the chain's span in the text. Matches may overlap; a chain
    counts what they add.
    """
    return _best(sorted(found), 0, most_gap, _reach(found, most_gap), float("inf"))


def all_chains(found: list[tuple[int, int, int, int]], length: int, least: float,
               most_gap: int = MOST_GAP) -> list[tuple[int, int, int]]:
    """The best chain, then the best of what lies before and after its span, and so on.

    All but the first cover ``least`` of the template's ``length`` words; spans do not overlap.
    """
    out: list[tuple[int, int, int]] = []
    reach = _reach(found, most_gap)
    left = [(sorted(found), 0)]  # matches, and from which on
    while left:
        matches, lo = left.pop()
        top = _best(matches, lo, most_gap, reach, length)
        if not out or top[0] / length >= least:
            out.append(top)
        if top[0] / length < least:
            continue
        _, start, stop = top
        after = bisect_left(matches, (stop,), lo)
        if after < len(matches):
            left.append((matches, after))
        before = [m for m in matches[lo:bisect_left(matches, (start,), lo)] if m[1] <= start]
        if before:
            left.append((before, 0))
    return out


class Scanner:
    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES,
                 phrases: Sequence[tuple[str, str]] = PHRASES):
        both = [*phrases, *((t, label) for label, t in templates)]
        self.labels = [label for _, label in both]
        self.phrases = len(phrases)
        sequences = [words_of(t.encode()) for t, _ in both]
        self.lengths = [len(s) for s in sequences]
        self.automaton = Automaton(sequences)

    def scan(self, words: list[bytes], least: float = LEAST_COVER) -> tuple[
            list[tuple[int, int]], dict[int, list[tuple[int, int, int]]]]:
        """Places of phrases (phrase, first word); by template covered words and span of its chains."""
        places: list[tuple[int, int]] = []
        matches: dict[int, list[tuple[int, int, int, int]]] = {}
        held = (-2, 0, 0)

        def closed(end: int, state: int, length: int) -> None:
            if length >= LEAST_MATCH:
                for template, at in self.automaton.ends[state]:
                    if template >= self.phrases:
                        matches.setdefault(template, []).append(
                            (end - length, end, at - length, at))

        for end, state, length in self.automaton.statistics(words):
            if not (end == held[0] + 1 and length == held[2] + 1):
                closed(*held)
            held = end, state, length
            for template, size in self.automaton.whole[state]:
                if template < self.phrases and size <= length:
                    places.append((template, end - size))
        closed(*held)
        return places, {t: all_chains(m, self.lengths[t], least) for t, m in matches.items()}


def scanned(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES,
            phrases: Sequence[tuple[str, str]] = PHRASES, least: float = LEAST_COVER) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    spans: label, first word and word after the last, covered share of every chain that counts.
    """
    bounded_batches(docs.sparkSession)
    scanner = Scanner(templates, phrases)
    spans = "array<struct<label: string, start: bigint, stop: bigint, share: double>>"

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text in texts(batch).to_pylist():
                words = words_of(text)
                places, covered = scanner.scan(words, least)
                base = {scanner.labels[t] for t, _ in places}
                starts = [at for _, at in places]
                shares = {t: c[0][0] / scanner.lengths[t] for t, c in covered.items()}
                good = [t for t in covered if shares[t] >= least]
                labels = base | {scanner.labels[t] for t in good}
                score = max([*shares.values(), 1.0 if base else 0.0])
                out.append((len(words), len(places), min(starts, default=None),
                            max(starts, default=None), ",".join(sorted(base)),
                            ",".join(sorted(labels)), score,
                            [{"label": scanner.labels[t], "start": start, "stop": stop,
                              "share": words_held / scanner.lengths[t]} for t in sorted(good)
                             for words_held, start, stop in sorted(covered[t], key=lambda c: c[1])]))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            struct = pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()),
                                ("share", pa.float64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), *columns,
                 pa.array([o[7] for o in out], pa.list_(struct))],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                 "score", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        scan, f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
              f"base_labels string, labels string, score double, spans {spans}")
