"""Mixing sources to target weights by hash thresholds.

Every source gets a target in words. What the target holds of whole rounds over the source, every
document is taken for; the rest is the budget of one more round, in which a document takes part if
its hash lies below its source's threshold. Thresholds come from histograms: words by source and
by the first three hexadecimal digits of the hash, then, inside the one bucket that the budget
ends in, by the next three, and so on. Nothing is sorted but histograms of 4,096 buckets, and
a lower budget always takes a subset of the documents (nested mixes).

Defined cases: a null text has no words and takes none; a null source is a source of its own, the
last; documents of one id share their hash and are taken or left together; an empty table gives an
empty result; columns other than doc_id, text and source are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelens.llm.text import WORD
from tradelens.session import materialise

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_ROUNDS = 2
DIGITS, LEVELS = 3, 4
_BEYOND = "g"  # after every hexadecimal digit


def _size() -> Column:
    words = F.regexp_count("text", F.lit(WORD))
    return F.coalesce(words, F.lit(0)).cast("bigint").alias("size")


def _hash() -> Column:
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return F.substring(F.md5(name), 1, DIGITS * LEVELS).alias("hash")


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and the hash that decides on the document."""
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), _size(), _hash())


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
            most: int = MOST_ROUNDS) -> DataFrame:
    """source, source_size, target, rounds (whole ones) and budget (of the last one).

    Targets are min(most * size, level * weight) with one level for all, which is where resharing
    the excess by weight ends. Sources are ordered by the size per weight at which they are full;
    the level is the largest of what is left per weight when all sources before one are full.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    filled = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    earlier = filled.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    found = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", weight.cast("bigint"))
        .withColumn("full_at", (most * F.col("source_size")).cast("double") / F.col("weight"))
        .withColumn("left", F.lit(share) * F.sum("source_size").over(every)
                    - F.coalesce(F.sum(most * F.col("source_size")).over(earlier), F.lit(0)))
        .withColumn("open", F.sum("weight").over(every)
                    - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
        .withColumn("level", F.max(F.col("left") / F.col("open")).over(every))
        .withColumn("target", F.least((most * F.col("source_size")).cast("double"),
                                      F.col("level") * F.col("weight"))))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    return found.select(
        "source", "source_size", "target",
        F.coalesce(rounds, F.lit(0)).cast("bigint").alias("rounds")
    ).withColumn("budget", F.col("target") - F.col("rounds") * F.col("source_size"))


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """For each source the hash below which a document takes part in the last round.

    The documents of the boundary hash take part if that comes nearer to the budget.
    """
    frontier = budgets.select(F.col("source").alias("of"), F.lit("").alias("prefix"),
                              F.col("budget").alias("rest"))
    for level in range(1, LEVELS + 1):
        bucket = F.substring("hash", 1, DIGITS * level)
        inside = F.substring("hash", 1, DIGITS * (level - 1)) == F.col("prefix")
        same = F.col("source").eqNullSafe(F.col("of"))
        upto = Window.partitionBy("of").orderBy("bucket")
        counted = (
            sized.where(F.col("size") > 0).join(frontier, same & inside)
            .groupBy("of", "rest", bucket.alias("bucket")).agg(F.sum("size").alias("held"))
            .withColumn("upto", F.sum("held").over(upto)))
        past = F.col("upto") > F.col("rest")
        if level == LEVELS:
            past &= 2 * F.col("upto") - F.col("held") >= 2 * F.col("rest")
        at = F.struct(F.col("bucket").alias("prefix"),
                      (F.col("rest") - F.col("upto") + F.col("held")).alias("rest"))
        found = counted.groupBy("of").agg(
            F.min_by(F.when(past, at), F.when(past, F.col("bucket"))).alias("at"),
            F.max("bucket").alias("last"))
        # In the last level nothing may be past the budget but what nearness lets in.
        all_in = F.concat("last", F.lit(_BEYOND)) if level == LEVELS else F.lit(None)
        frontier = found.select(
            "of", F.coalesce("at.prefix", all_in).alias("prefix"), "at.rest").where("prefix IS NOT NULL")
    return budgets.join(frontier, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "source", "source_size", "target", "rounds",
        F.coalesce("prefix", F.lit(_BEYOND)).alias("threshold"))


def _settled(docs: DataFrame, weights: Sequence[int], share: float, most: int
             ) -> tuple[DataFrame, DataFrame]:
    """The documents' sizes, and by source what is taken; both written, hence of known size."""
    sized = materialise(sizes(docs))
    found = thresholds(sized, targets(sized, weights, share, most))
    return sized, materialise(found).withColumnRenamed("source", "of")


def _taken() -> Column:
    again = (F.col("hash") < F.col("threshold")).cast("bigint")
    return (F.col("size") * (F.col("rounds") + again)).alias("taken")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
        most: int = MOST_ROUNDS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every document.

    ``taken`` is the document's size times the rounds it takes part in. Words are counted once and
    the counts written to the session's checkpoint folder.
    """
    sized, found = _settled(docs, weights, share, most)
    return sized.join(found, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "source_size", "target", _taken())


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
          most: int = MOST_ROUNDS) -> DataFrame:
    """The documents that are taken, with all their columns, and size, target and taken.

    A column of docs that has one of these names gives way to it.
    """
    _, found = _settled(docs, weights, share, most)
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text", "source")
    sized = rows.select("row", F.col("source").cast("string").alias("source"), _size(), _hash())
    out = sized.join(found, F.col("source").eqNullSafe(F.col("of"))).select(
        "row", "size", "target", _taken()).where("taken > 0")
    named = [c for c in docs.columns if c not in ("size", "target", "taken")]
    return out.select(*[F.col("row").getField(c).alias(c) for c in named],
                      "size", "target", "taken")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'null'))[1:12] AS hash
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE place % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS weight FROM sources),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - coalesce(sum(2 * source_size) OVER earlier, 0)::DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0))::DOUBLE AS level
  FROM weighed
  WINDOW earlier AS (ORDER BY (2 * source_size)::DOUBLE / weight, place
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT source, source_size,
         least((2 * source_size)::DOUBLE, max(level) OVER () * weight::DOUBLE) AS target
  FROM levels),
rounds AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS rounds
  FROM goals),
placed AS (
  SELECT s.*, r.source_size, r.target, r.rounds, r.target - r.rounds * r.source_size AS budget,
         sum(size) OVER (PARTITION BY s.source ORDER BY hash) AS upto,
         sum(size) OVER (PARTITION BY s.source, hash) AS same
  FROM sized s JOIN rounds r ON s.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, source, size, source_size, target,
       (size * (rounds + CASE WHEN 2 * upto - same < 2 * budget THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""
