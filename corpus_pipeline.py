"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; all but the last
return the columns of documents. ``run`` writes every stage's result to the session's checkpoint
folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradelens.llm import decontaminate, mixing, neardup, quality, suffix
from tradelens.llm.text import table
from tradelens.session import materialise

SHINGLE = 5  # words; op5_minhash compares by two


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; the likelihoods are those of these documents."""
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, by shingles of ``SHINGLE`` words."""
    return neardup.unique(docs, width=SHINGLE)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What a document repeats of earlier ones is cut out of its text."""
    return suffix.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: documents with their size, their source's target and the words taken."""
    return mixing.mixed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing", mixture),
]

ORACLE_SQL = None  # SQL has no suffix arrays; tests/llm compares the stages with plain loops


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
