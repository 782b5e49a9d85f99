from __future__ import annotations

import hashlib

import pytest
from tests.llm import plain

from tradelens.llm import warc
from tradelens.session import shared_path

PAGES = "page_id bigint, url string, html string"
LONG = "é" * 600


def _pages():
    return [(1, "http://a.example/", LONG), (9, "http://b.example/\r\nx", LONG), (5, None, LONG),
            (None, "u", LONG), (2, "u", "short"), (3, "u", "short"), (4, "u", None), (6, "u", ""),
            (7, "u", "x" * 1000), (8, "u", "y" * 999), (10, "u", "y" * 999),
            (11, "u", "WARC/1.1\r\nWARC-Type: revisit\r\n\r\n" * 40), (9, "http://b.example/\r\nx", LONG)]


def _by_plain(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        last = max(same, default=None)
        revisit = len(data) >= 1000 and page != last
        out.append((page, len(data), hashlib.sha1(data).hexdigest(),
                    "revisit" if revisit else "response", last if revisit else None))
    return plain.by_text(out)


@pytest.fixture(scope="module")
def stored(spark):
    path = shared_path(spark)
    pages = spark.createDataFrame(_pages(), PAGES).selectExpr("*", "1 AS key", "'x' AS header", "2 AS type")
    warc.archive(pages.repartition(4), path)
    return path


def test_index(spark, stored):
    assert plain.by_text([tuple(r) for r in warc.index(spark, stored).collect()]) == _by_plain(_pages())


def test_every_record_comes_back_exactly(spark, stored):
    got = sorted((bytes(r.record), bytes(r.payload)) for r in warc.records(spark, stored).collect())
    wanted = []
    for (page, url, html), (_, n, digest, kind, refers) in zip(
            sorted(_pages(), key=lambda p: str(p[0])),
            sorted(_by_plain(_pages()), key=lambda p: str(p[0]))):
        data = (html or "").encode()
        head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'null' if page is None else page}>"]
        if url is not None:
            head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
        head.append(f"WARC-Payload-Digest: sha1:{hashlib.sha1(data).hexdigest()}")
        if kind == "revisit":
            head += [f"WARC-Profile: {warc.PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>"]
        head += ["Content-Type: text/html; charset=UTF-8",
                 f"Content-Length: {0 if kind == 'revisit' else len(data)}"]
        record = "\r\n".join(head).encode() + b"\r\n\r\n" + (data if kind == "response" else b"") + b"\r\n\r\n"
        wanted.append((record, data))
    assert got == sorted(wanted)


def test_payloads_are_stored_once(spark, stored):
    payloads = [bytes(r.payload) for r in spark.read.parquet(f"{stored}/payloads").collect()]
    assert len(payloads) == len(set(payloads)) == len({(h or "") for _, _, h in _pages()})


def test_damage_is_noticed(spark, stored):
    path = shared_path(spark)
    spark.read.parquet(f"{stored}/headers").write.parquet(f"{path}/headers")
    spark.read.parquet(f"{stored}/payloads").selectExpr(
        "key", "sha1", "n_bytes", "concat(payload, X'00') AS payload").write.parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.index(spark, path).collect()


def test_empty(spark):
    path = shared_path(spark)
    warc.archive(spark.createDataFrame([], PAGES), path)
    assert warc.index(spark, path).collect() == warc.records(spark, path).collect() == []
