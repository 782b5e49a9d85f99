"""Content-addressed archive of WARC records.

``archive`` writes two tables: ``headers``, one exact record header per page, and ``payloads``,
every payload's bytes once under its SHA-256. Of records with equal payloads of at least
``LEAST_REVISIT`` bytes that of the largest page_id is a response and the others are revisits that
refer to it; a revisit's own block is empty, and its header says so. ``records`` puts every record
together again by a join of the two and checks each payload against both its digests.

Payloads count as equal if SHA-256, SHA-1 and length agree; when one SHA-256 comes with two
lengths or two SHA-1s, writing fails instead of merging them.

Defined cases: a null html is an empty payload; a null url gives a header without a target line;
line ends in urls are percent-encoded. A null page_id counts as smaller than all others. Rows that
repeat the page_id of a response, payload included, are responses too. Empty tables give empty
archives; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST_REVISIT = 1000
CRLF = "\r\n"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _payload() -> Column:
    return F.encode(F.coalesce("html", F.lit("")), "UTF-8")


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def _header() -> Column:
    """The header block of a record, up to and with its empty line."""
    revisit = F.col("type") == "revisit"
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("type")),
        F.concat(F.lit("WARC-Record-ID: "), _urn(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _urn(F.col("refers_to")))),
        F.lit("Content-Type: text/html; charset=UTF-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, 0).otherwise(F.col("n_bytes"))),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF))


def archive(pages: DataFrame, path: str) -> None:
    """Writes ``path``/headers and ``path``/payloads.

    Digests meet in small rows; payloads move once, merged before they do.
    """
    payload = _payload()
    seen = pages.select("page_id", "url", F.sha2(payload, 256).alias("key"),
                        F.sha1(payload).alias("sha1"), F.octet_length(payload).alias("n_bytes"))
    groups = seen.groupBy("key").agg(F.max("page_id").alias("last"))
    revisit = (F.col("n_bytes") >= LEAST_REVISIT) & ~F.col("page_id").eqNullSafe(F.col("last"))
    typed = seen.join(groups, "key").withColumns({
        "type": F.when(revisit, "revisit").otherwise("response"),
        "refers_to": F.when(revisit, F.col("last"))})
    typed.select("page_id", "key", _header().alias("header")).write.option(
        "compression", "zstd").parquet(f"{path}/headers")

    def same(name: str) -> Column:
        return F.when(F.min(name) == F.max(name), F.min(name)).otherwise(
            F.raise_error(F.lit("one SHA-256 stands for two payloads"))).alias(name)

    stored = pages.select(payload.alias("payload")).select(
        F.sha2("payload", 256).alias("key"), F.sha1("payload").alias("sha1"),
        F.octet_length("payload").alias("n_bytes"), "payload")
    stored.groupBy("key").agg(same("sha1"), same("n_bytes"), F.first("payload").alias("payload")) \
        .write.option("compression", "zstd").parquet(f"{path}/payloads")


def _line(name: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def _page(name: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: <urn:page:(-?[0-9]+)>\r\n", 1)


def _checked(payloads: DataFrame) -> DataFrame:
    """Payloads whose bytes still have the digests they are stored under; others end the job."""
    good = ((F.sha2("payload", 256) == F.col("key"))
            & (F.sha1("payload") == F.col("sha1")))
    return payloads.withColumn("sha1", F.when(good, F.sha1("payload")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), F.col("key")))))


def _joined(spark: SparkSession, path: str, payloads: DataFrame) -> DataFrame:
    headers = spark.read.parquet(f"{path}/headers")
    told = F.regexp_extract("header", r"\r\nWARC-Payload-Digest: sha1:([0-9a-f]{40})\r\n", 1)
    return headers.join(payloads, "key").withColumn("sha1", F.when(
        told == F.col("sha1"), F.col("sha1")).otherwise(
            F.raise_error(F.lit("a header does not belong to its payload"))))


def records(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record (all bytes of the WARC record) and payload (a revisit's is the response's)."""
    whole = _joined(spark, path, _checked(spark.read.parquet(f"{path}/payloads")))
    head = F.encode("header", "UTF-8")
    block = F.when(_line("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return whole.select("page_id", F.concat(head, block, F.lit(END)).alias("record"), "payload",
                        "sha1")


def index(spark: SparkSession, path: str) -> DataFrame:
    """What the archive holds, by page: payload_bytes, payload_digest, record_type, refers_to.

    Lengths and digests are taken from the stored bytes, everything else from the headers.
    """
    stored = _checked(spark.read.parquet(f"{path}/payloads")).select(
        "key", "sha1", F.octet_length("payload").cast("bigint").alias("payload_bytes"))
    refers = _page("WARC-Refers-To")
    page = _page("WARC-Record-ID")
    return _joined(spark, path, stored).select(
        F.when(page != "", page.cast("bigint")).alias("page_id"), "payload_bytes",
        F.col("sha1").alias("payload_digest"), _line("WARC-Type").alias("record_type"),
        F.when(refers != "", refers.cast("bigint")).alias("refers_to"))


ORACLE = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages)
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN octet_length(payload) < 1000 OR page_id = last THEN 'response' ELSE 'revisit' END
         AS record_type,
       CASE WHEN octet_length(payload) >= 1000 AND page_id <> last THEN last END AS refers_to
FROM (SELECT *, max(page_id) OVER (PARTITION BY payload) AS last FROM p)
"""
