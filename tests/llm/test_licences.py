from __future__ import annotations

import random
import re

from tests.llm import plain

from tradelens.llm import licences


def test_automaton_against_all_stretches():
    rng = random.Random(1)
    for _ in range(150):
        templates = [[bytes([rng.choice(b"abc")]) for _ in range(rng.randint(1, 8))]
                     for _ in range(rng.randint(1, 4))]
        automaton = licences.Automaton(templates)
        text = [bytes([rng.choice(b"abcd")]) for _ in range(30)]
        ends: dict[tuple, set] = {}
        for number, words in enumerate(templates):
            for i in range(len(words)):
                for j in range(i + 1, len(words) + 1):
                    ends.setdefault(tuple(words[i:j]), set()).add((number, j))
        got = {end: (state, n) for end, state, n in automaton.statistics(text)}
        for end in range(1, len(text) + 1):
            n = max((k for k in range(1, end + 1) if tuple(text[end - k:end]) in ends), default=0)
            if n < 2:
                assert end not in got
                continue
            state, length = got[end]
            assert length == n
            assert set(automaton.ends[state]) == ends[tuple(text[end - n:end])]


def test_base_columns_by_plain_search(spark):
    rows = plain.odd_documents() + [
        (900, "MIT-License, the MIT license! cc by cc BY. GNU General  Public\tLicense", "en", "a", 1),
        (901, "Apache_License apache license2 İmit license", None, None, 0)]
    docs = spark.createDataFrame(rows, plain.DOCS)
    found = {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
             for r in licences.scanned(docs).collect()}
    wanted = set()
    for doc_id, text, *_ in rows:
        low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(i, label) for phrase, label in licences.PHRASES for i in range(len(words))
                  if words[i:i + len(phrase.split())] == phrase.split()]
        at = [i for i, _ in places]
        wanted.add((doc_id, len(words), len(places), min(at, default=None), max(at, default=None),
                    ",".join(sorted({label for _, label in places}))))
    assert found == wanted


def test_templates_in_part_and_with_changes(spark):
    bsd = dict(licences.TEMPLATES)["bsd"].split()
    texts = {1: " ".join(bsd), 2: "x " + " ".join(bsd[:50]) + " y", 3: " ".join(bsd[:20]),
             4: " ".join(w if i % 9 else "other" for i, w in enumerate(bsd)), 5: "", 6: None,
             7: "Nothing of the kind " * 3000}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id int, text string")
    found = {r.doc_id: r for r in licences.scanned(docs).collect()}
    assert found[1].labels == "bsd" and found[1].score == 1.0
    assert (found[1].spans[0].start, found[1].spans[0].stop) == (0, len(licences.words_of(texts[1].encode())))
    assert found[2].labels == "bsd" and 0.6 < found[2].score < 1
    assert found[3].labels == "" and 0 < found[3].score < 0.6
    assert found[4].labels == "bsd"
    assert all((found[i].labels, found[i].score, found[i].n_base) == ("", 0.0, 0) for i in (5, 6, 7))


def test_chain_takes_the_best_of_many():
    assert licences.chains([(0, 5, 0, 5), (6, 10, 6, 10), (40, 45, 0, 5)]) == (9, 0, 10)
    assert licences.chains([(0, 5, 10, 15), (6, 10, 0, 4)]) == (5, 0, 5)


def test_empty_table(spark):
    assert licences.scanned(spark.createDataFrame([], plain.DOCS)).collect() == []


def test_one_notice_several_times(spark):
    bsd = dict(licences.TEMPLATES)["bsd"].split()
    part = bsd[:50]
    mit = "Released under the MIT License."
    texts = {1: " ".join(bsd + ["code"] * 100 + bsd), 2: " ".join(bsd + part + bsd), 3: " ".join([mit] * 4000),
             4: " ".join(bsd + ["code"] * 100 + bsd[:20])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    found = {r.doc_id: [(s.start, s.stop) for s in r.spans if s.label in ("bsd", "mit")]
             for r in licences.scanned(docs).collect()}
    n, m = len(licences.words_of(" ".join(bsd).encode())), len(licences.words_of(" ".join(part).encode()))
    assert found[1] == [(0, n), (n + 100, 2 * n + 100)]
    assert found[2] == [(0, n), (n, n + m), (n + m, 2 * n + m)]
    assert found[3] == [(5 * i, 5 * i + 5) for i in range(4000)]
    assert found[4] == [(0, n)]


def test_all_chains_are_the_best_of_what_is_left():
    rng = random.Random(8)

    def plain_chains(found):
        if not found:
            return []
        top = licences.chains(found)
        if top[0] / 10 < 0.6:
            return []
        return [top, *plain_chains([f for f in found if f[1] <= top[1]]),
                *plain_chains([f for f in found if f[0] >= top[2]])]

    for _ in range(200):
        found = []
        for _ in range(rng.randint(1, 25)):
            a, x, size = rng.randrange(60), rng.randrange(7), rng.randint(4, 10)
            size = min(size, 10 - x)
            found.append((a, a + size, x, x + size))
        wanted = sorted(plain_chains(found)) or [licences.chains(found)]
        assert sorted(licences.all_chains(found, 10, 0.6)) == wanted
