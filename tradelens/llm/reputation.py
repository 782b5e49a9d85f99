"""URL filters: fixed rules, then empirical-Bayes reputation of hosts. DataFrame functions only.

Labelled page outcomes are counted by host, the counts summed by registered domain (the last two
labels of the host) and by suffix (the last one). Each level is a beta-binomial whose prior mean is
the posterior mean of the level above and whose strength is estimated from all groups of the level
by moments: with p = k / n, the weighted squares n (p - m)^2 are expected to sum to
m (1 - m) (1 + (n - 1) r), which gives the correlation r, and the strength 1 / r - 1. A host is
blocked if the lower posterior bound of its share of bad pages lies above a limit; hosts without
labels stand on their domain's or suffix's posterior.

Defined cases: a null url, or one without "://", has an empty host and an empty path; the empty
host is a host like others. Pages of one id are judged row by row. Without labels every prior is
one half at least strength and nothing is blocked but by rule. Tables may be empty, other columns
are not looked at.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelens.session import materialise

# Fixed rules: verdict, host, path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
LIMIT, BOUND_Z = 0.5, 1.645
LEAST_R, MOST_R = 1e-4, 0.5  # the strength stays between 1 and 9,999


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, host and path."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase,
                       string.ascii_lowercase)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return pages.select("page_id", F.coalesce(host, F.lit("")).alias("host"),
                        F.coalesce(path, F.lit("")).alias("path"))


def by_rule(rules: Sequence[tuple[str, str, str]], what: str) -> Column:
    """The longest fitting rule ("rule") or its verdict ("verdict"), else null."""
    found = F.lit(None).cast("string")
    for verdict, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        inside = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits = inside & F.col("path").startswith(path)
        found = F.when(fits, host + path if what == "rule" else verdict).otherwise(found)
    return found


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per labelled page: host, bad. A page's document is the number its path ends with."""
    number = F.regexp_extract("path", r"([0-9]{1,18})(?:/|\.html)?$", 1)
    of = F.when(number != "", number.cast("bigint"))
    told = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("of"))
            .agg(F.max((F.coalesce(F.col("toxic") == 1, F.lit(False))
                        | F.coalesce(F.col("quality") == 0, F.lit(False))).cast("bigint"))
                 .alias("bad")))
    return parsed(pages).select("host", of.alias("of")).join(told, "of").select("host", "bad")


def _strength(groups: DataFrame, mean: str) -> float:
    """The level's strength, estimated over all its groups with labels: one number."""
    spread = F.col(mean) * (1 - F.col(mean))
    off = F.col("k") / F.col("n") - F.col(mean)
    moments = groups.where(F.col("n") > 0).agg(
        F.sum(F.col("n") * off * off - spread).alias("over"),
        F.sum((F.col("n") - 1) * spread).alias("base"))
    r = F.when(F.col("base") > 0, F.col("over") / F.col("base"))
    r = F.greatest(F.lit(LEAST_R), F.least(F.lit(MOST_R), F.coalesce(r, F.lit(MOST_R))))
    return moments.select((1 / r - 1).alias("strength")).first()["strength"]


def _posterior(groups: DataFrame, mean: str, name: str) -> DataFrame:
    weight = F.lit(_strength(groups, mean))
    a = weight * F.col(mean) + F.col("k")
    return groups.withColumns({name: a / (weight + F.col("n")),
                               f"{name}_weight": weight + F.col("n")})


def reputation(hosts: DataFrame, told: DataFrame, z: float = BOUND_Z) -> DataFrame:
    """host, labelled, bad, mean and lower bound of the share of bad pages, for every host.

    The hosts' counts are written to the session's checkpoint folder; of the priors four numbers
    go through the driver.
    """
    counts = told.groupBy("host").agg(F.count("bad").alias("n"), F.sum("bad").alias("k"))
    every = materialise(
        hosts.select("host").distinct().join(counts, "host", "left").fillna(0, ["n", "k"])
        .withColumn("domain", F.substring_index("host", ".", -2))
        .withColumn("suffix", F.substring_index("host", ".", -1)))
    domains = every.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    whole = every.agg(F.coalesce(
        F.sum("k") / F.nullif(F.sum("n"), F.lit(0)), F.lit(0.5)).alias("mean")).first()["mean"]

    suffixes = _posterior(suffixes.withColumn("m0", F.lit(whole)), "m0", "m1").select("suffix", "m1")
    domains = _posterior(domains.join(suffixes, "suffix"), "m1", "m2").select("domain", "m2")
    every = _posterior(every.join(domains, "domain"), "m2", "mean")
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("mean_weight") + 1))
    return every.select("host", F.col("n").alias("labelled"), F.col("k").alias("bad"), "mean",
                        (F.col("mean") - z * spread).alias("bound"))


def judge(pages: DataFrame, told: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
          limit: float = LIMIT, z: float = BOUND_Z) -> DataFrame:
    """page_id, host, path, rule, verdict, host_labelled, host_bad for every page."""
    urls = parsed(pages)
    known = reputation(urls, told, z).select(
        "host", F.col("labelled").alias("host_labelled"), F.col("bad").alias("host_bad"),
        F.when(F.col("bound") > limit, "block").otherwise("allow").alias("earned"))
    return urls.join(known, "host").select(
        "page_id", "host", "path", by_rule(rules, "rule").alias("rule"),
        F.coalesce(by_rule(rules, "verdict"), "earned").alias("verdict"),
        "host_labelled", "host_bad")


ORACLE = r"""
WITH rests AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN url[instr(url, '://') + 3:] END AS rest
  FROM pages),
urls AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM rests),
told AS (
  SELECT doc_id AS of, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
counts AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS k
  FROM urls LEFT JOIN told
    ON of = nullif(regexp_extract(path, '([0-9]{1,18})(?:/|\.html)?$', 1), '')::BIGINT
  GROUP BY host),
hosts AS (
  SELECT *, array_to_string(string_split(host, '.')[-2:], '.') AS domain,
         string_split(host, '.')[-1] AS suffix FROM counts),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY ALL),
whole AS (SELECT coalesce(sum(k) / nullif(sum(n), 0), 0.5)::DOUBLE AS m0 FROM suffixes),
s0 AS (SELECT * FROM suffixes, whole),
s1 AS (SELECT 1 / greatest(0.0001::DOUBLE, least(0.5::DOUBLE, coalesce(
         sum(n * (k / n - m0) * (k / n - m0) - m0 * (1 - m0)) FILTER (n > 0)
         / nullif(sum((n - 1) * m0 * (1 - m0)) FILTER (n > 0), 0), 0.5))) - 1 AS w FROM s0),
s2 AS (SELECT suffix, (w * m0 + k) / (w + n) AS m1 FROM s0, s1),
d0 AS (SELECT domains.*, m1 FROM domains JOIN s2 USING (suffix)),
d1 AS (SELECT 1 / greatest(0.0001::DOUBLE, least(0.5::DOUBLE, coalesce(
         sum(n * (k / n - m1) * (k / n - m1) - m1 * (1 - m1)) FILTER (n > 0)
         / nullif(sum((n - 1) * m1 * (1 - m1)) FILTER (n > 0), 0), 0.5))) - 1 AS w FROM d0),
d2 AS (SELECT domain, (w * m1 + k) / (w + n) AS m2 FROM d0, d1),
h0 AS (SELECT hosts.*, m2 FROM hosts JOIN d2 USING (domain)),
h1 AS (SELECT 1 / greatest(0.0001::DOUBLE, least(0.5::DOUBLE, coalesce(
         sum(n * (k / n - m2) * (k / n - m2) - m2 * (1 - m2)) FILTER (n > 0)
         / nullif(sum((n - 1) * m2 * (1 - m2)) FILTER (n > 0), 0), 0.5))) - 1 AS w FROM h0),
h2 AS (SELECT host, n, k, (w * m2 + k) / (w + n) AS mean, w + n AS weight FROM h0, h1),
earned AS (
  SELECT host, n, k, CASE WHEN mean - 1.645::DOUBLE * sqrt(mean * (1 - mean) / (weight + 1))
                          > 0.5 THEN 'block' ELSE 'allow' END AS verdict FROM h2),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM urls)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block' ELSE verdict END AS verdict,
       n AS host_labelled, k AS host_bad
FROM ruled JOIN earned USING (host)
"""
