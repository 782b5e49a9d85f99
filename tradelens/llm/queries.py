"""The operators' queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradelens.llm import (
    alignment, decontaminate, language, licences, mixing, neardup, packing, phrases, quality,
    reputation, suffix, variants, warc,
)
from tradelens.llm.text import table
from tradelens.session import shared_path


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.deduplicated(table(spark, folder, "documents"))


def op3_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scanned(table(spark, folder, "documents"))


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.predict(table(spark, folder, "documents"))


def op5_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"))


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark)
    warc.archive(table(spark, folder, "pages"), path)
    return warc.index(spark, path)


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(table(spark, folder, "documents"),
                                 table(spark, folder, "benchmark"))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return reputation.judge(pages, reputation.outcomes(pages, table(spark, folder, "labels")))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op10_phrase_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.deduplicated(table(spark, folder, "documents"))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.aligned(table(spark, folder, "documents"))


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


def op13_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.variants(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_licences": op3_licences,
    "op4_language": op4_language,
    "op5_minhash": op5_minhash,
    "op6_warc": op6_warc,
    "op7_decontaminate": op7_decontaminate,
    "op8_url_filter": op8_url_filter,
    "op9_mixing": op9_mixing,
    "op10_phrase_dedup": op10_phrase_dedup,
    "op11_alignment": op11_alignment,
    "op12_packing": op12_packing,
    "op13_variants": op13_variants,
}

ORACLES = {
    "op6_warc": warc.ORACLE,
    "op8_url_filter": reputation.ORACLE,
    "op9_mixing": mixing.ORACLE,
}
