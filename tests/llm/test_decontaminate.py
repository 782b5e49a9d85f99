from __future__ import annotations

import itertools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm import plain

from tradelens.llm import decontaminate

ITEMS = "item_id bigint, text string"
QUESTION = ("Yesterday Anna bought 12 apples for 5 dollars and gave 5 apples to Bert, who then walked "
            "3 km to the market where Anna had found them")


def _found(spark, texts, items, **more):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    out = decontaminate.matches(docs, spark.createDataFrame(items, ITEMS), **more).collect()
    return {r.doc_id: r for r in out}


# What stands for something else in the question: the words of each type, in any of the variants.
SLOTS = [{"Anna", "Bert", "Clara", "Dora", "Eve"}, {"12", "5", "30", "7", "9", "3", "4"},
         {"dollars", "euros", "km", "miles"}]


def _longest(item: str, document: str) -> int:
    """The longest stretch of equal words and of slots that map one to one, of all stretches."""
    a, b = item.split(), document.split()
    kind = [next((k for k, words in enumerate(SLOTS) if w.strip(",.") in words), None) for w in a]

    def consistent(i: int, j: int) -> bool:
        there, back = {}, {}
        for k in range(i, j):
            x, y = a[k].strip(",."), b[k].strip(",.")
            if kind[k] is None:
                if x != y:
                    return False
            elif y not in SLOTS[kind[k]] or there.setdefault(x, y) != y or back.setdefault(y, x) != x:
                return False
        return True
    return max(j - i for i in range(len(a)) for j in range(i, len(a) + 1) if consistent(i, j))


@pytest.mark.parametrize("least", [20, 22])
def test_same_question_with_other_names_numbers_and_units(spark, least):
    asked = ("Yesterday Clara bought 30 apples for 7 euros and gave 7 apples to Dora, who then walked "
             "4 miles to the market where Clara had found them")
    swapped = asked.replace("gave 7", "gave 9").replace("where Clara", "where Eve")
    merged = QUESTION.replace("Bert", "Anna")  # two names of the item become one
    variants = [QUESTION, asked, swapped, merged]
    texts = [QUESTION, *(f"Intro. {v}. End." for v in variants[1:]), "nothing " * 40, None, ""]
    found = _found(spark, texts, [(1, QUESTION)], least=least)
    runs = [_longest(QUESTION, v) for v in variants]
    assert runs[0] == runs[1] == len(QUESTION.split()) and 20 <= runs[2] < 22 and 20 <= runs[3] < 22
    assert [found[i].items for i in range(7)] == [[1] if n >= least else [] for n in runs] + [[], [], []]
    assert [found[i].longest_run for i in range(4)] == [n if n >= least else 0 for n in runs]
    assert all(r.kept != r.contaminated for r in found.values())


def test_every_document_that_holds_an_item_is_found(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    holds = {d: sorted(r.item_id for r in items.collect() if r.text in t) for d, t in texts.items()}
    found = {r.doc_id: r.items for r in decontaminate.matches(docs, items).collect()}
    assert {d for d, i in found.items() if i} == {d for d, i in holds.items() if i}
    assert all(set(holds[d]) <= set(found[d]) for d in holds)


def test_blocks_give_the_same(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    one = sorted(map(str, decontaminate.matches(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 400)
    assert len(list(decontaminate._blocks(items))) > 2
    assert sorted(map(str, decontaminate.matches(docs, items).collect())) == one


def test_odd_rows(spark):
    rows = plain.odd_documents()
    docs = spark.createDataFrame(rows, plain.DOCS).withColumns(
        {"items": F.lit(1), "row": F.lit(2), "longest_run": F.lit("x")})
    passage = " ".join(next(r[1] for r in rows if r[1] and len(r[1].split()) == 3000).split()[100:140])
    items = spark.createDataFrame([(1, passage), (1, passage), (None, passage), (2, None), (3, ""),
                                   (4, "too short")], ITEMS)
    found = decontaminate.matches(docs, items).collect()
    assert len(found) == len(rows)
    held = [passage in " ".join((r[1] or "").split()) for r in rows]
    assert sorted((str(r.doc_id), r.contaminated) for r in found) \
        == sorted((str(r[0]), h) for r, h in zip(rows, held))
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(rows) - sum(held)


@pytest.mark.parametrize("side", ["docs", "items"])
def test_empty(spark, side):
    docs = spark.createDataFrame([(1, QUESTION)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, QUESTION)], ITEMS)
    if side == "docs":
        assert decontaminate.matches(docs.limit(0), items).collect() == []
    else:
        assert [r.kept for r in decontaminate.matches(docs, items.limit(0)).collect()] == [True]


def _template(words):
    return decontaminate.Template([w.encode() for w in words], decontaminate.Words())


def _consistent(pairs):
    return all((x == u) == (y == v) for x, y in pairs for u, v in pairs)


def test_longest_consistent_against_all_stretches():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(1, 25)
        mine = [rng.choice(["w", "w", "1", "2", "3"]) for _ in range(n)]
        other = [("w" if rng.random() < 0.95 else "v") if w == "w" else rng.choice("4567") for w in mine]
        best = max((j - i for i in range(n) for j in range(i, n + 1)
                    if all(x == y for x, y in zip(mine[i:j], other[i:j]) if "w" in (x, y))
                    and _consistent([p for p in zip(mine[i:j], other[i:j]) if p[0] != "w"])), default=0)
        assert decontaminate.longest_consistent(_template(mine), _template(other), 0, 0, n) == best


def test_a_repeated_number_that_changes_does_not_end_the_run():
    words = [f"w{i}x" for i in range(31)]
    item, text = list(words), list(words)
    for place, value in ((2, "4"), (11, "5"), (20, "6")):
        item[place], text[place] = "3", value
    assert decontaminate.longest_consistent(_template(item), _template(text), 0, 0, 31) == 19


def _runs(asked, text, least=decontaminate.LEAST_RUN):
    batch = pa.RecordBatch.from_pydict({"text": [text], "items": pa.array([[]], pa.list_(pa.int64())),
                                        "longest_run": [0]})
    found = decontaminate.Table([(1, asked.encode())], decontaminate.WINDOW, decontaminate.LEAST_PLAIN)
    out = next(decontaminate._find(found, decontaminate.WINDOW, decontaminate.LEAST_PLAIN, least)([batch]))
    return out["longest_run"][0].as_py()


SHORT = ("Anna has 12 apples in her old basket. Anna gives 5 of them to a friend. "
         "Then she walks to the market with the rest.")


def test_names_that_open_sentences():
    assert _runs(SHORT, SHORT) == 25
    assert _runs(SHORT, SHORT.replace("Anna", "Clara")) == 25
    assert _runs(SHORT, SHORT.replace("Anna gives", "Clara gives")) >= 17
    assert _runs(SHORT, SHORT.replace("Then", "then")) == 25
    both = SHORT.replace("Anna has", "Anna has seen that Anna has")
    assert _runs(both, both.replace("Anna", "Clara")) == 29


def test_copies_without_punctuation():
    bare = SHORT.replace(".", "")
    assert _runs(SHORT, bare) == 25 and _runs(bare, SHORT) == 25
    assert _runs(SHORT, bare.replace("Anna", "Clara")) == 25


def test_windows_come_in_every_reading(monkeypatch):
    monkeypatch.setattr(decontaminate, "READ_AT_ONCE", 5)
    rng = random.Random(6)
    words = [rng.choice(["Aa.", "Bb.", "cc", "dd", "9", "Ee"]) for _ in range(60)]
    text = _template(words)
    at, hashes = text.all_windows(8, 5)
    wanted = set()
    for i in range(len(words) - 7):
        openers = [j for j in range(i, i + 8) if text.openers[j]]
        for taken in itertools.product([0, 1], repeat=len(openers)):
            codes = text.codes[i:i + 8].copy()
            names = [j - i for j, t in zip(openers, taken) if t]
            codes[names] = decontaminate._SLOT_HASH[decontaminate.NAME]
            if (text.slots[i:i + 8] == 0).sum() - len(names) >= 5:
                wanted.add((i, int(decontaminate.rolled(codes, 8)[0])))
    assert sorted(zip(at.tolist(), hashes.tolist())) == sorted(wanted)


def test_words_of_ascii_are_read_as_all_words_are(monkeypatch):
    """The way without decoding gives what the other one gives."""
    rng = random.Random(6)
    raw = ["".join(rng.choice("aZ09.,:/!?-_'(\x01") for _ in range(rng.randint(1, 6))) for _ in range(3000)]
    raw += ["1st", "2ND", "3.5kg", "Kilograms,", "__", "-a", "KM", "9,", "(Anna)", "ok.", "x:", "\x1f"]

    class Seen(bytes):
        def isascii(self):
            return False

    def codes(kind):
        words = decontaminate.Words()
        return [words[kind(w.encode())] for w in raw]

    fast = codes(bytes)
    calls = []
    monkeypatch.setattr(decontaminate.Words, "_of_ascii", lambda self, w: calls.append(w))
    assert codes(Seen) == fast and not calls


def test_only_windows_that_may_be_known_are_searched():
    table = decontaminate.Table([(1, QUESTION.encode())], 8, 5)
    places, known = table.items[0].all_windows(8, 5)
    import numpy as np
    others = np.arange(1, 100_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert table.begun[others >> table.unseen].mean() < 0.2
    row, at = table.hits(np.arange(len(known) + len(others)), np.concatenate([known, others]))
    assert set(at.tolist()) == set(range(len(known))) and (table.hashes[row] == known[at]).all()
