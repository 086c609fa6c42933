"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import (
    decontamination,
    jaccard_join,
    language_id,
    lexical_search,
    license_scan,
    line_dedup,
    line_quality,
    periodic_runs,
    pii_spans,
    preference,
    quality_classifier,
    source_mix,
    sql,
    substring_dedup,
)
from basketry.llm.frames import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.report(table(spark, folder, "documents"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.report(table(spark, folder, "documents"))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_quality.report(table(spark, folder, "documents"))


def op4_pii_spans(spark: SparkSession, folder: str) -> DataFrame:
    return pii_spans.report(table(spark, folder, "documents"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.report(table(spark, folder, "documents"))


def op7_preference(spark: SparkSession, folder: str) -> DataFrame:
    return preference.report(table(spark, folder, "conversations"), preference.following_replies)


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.report(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return source_mix.report(table(spark, folder, "documents"))


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.report(table(spark, folder, "documents"))


def op10_jaccard_links(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.report_links(table(spark, folder, "documents"))


def op11_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.report(table(spark, folder, "documents"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.report(table(spark, folder, "documents"))


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_line_dedup, op2_substring_dedup, op3_quality_rules, op4_pii_spans, op5_decontamination, op6_language_id, op7_preference, op8_quality_classifier, op9_source_mix, op10_jaccard_join, op10_jaccard_links, op11_license_scan, op12_periodic_runs, op13_lexical_search)}


def oracles() -> dict[str, str]:
    return {
        "op1_line_dedup": sql.line_dedup_report("documents"),
        "op2_substring_dedup": sql.repeats("documents"),
        "op3_quality_rules": sql.quality_report("documents"),
        "op5_decontamination": sql.contamination("documents"),
        "op9_source_mix": sql.mix_report("documents"),
        "op10_jaccard_join": sql.near_duplicates("documents"),
        "op10_jaccard_links": sql.near_duplicate_links("documents"),
        "op11_license_scan": sql.license_report("documents"),
        "op12_periodic_runs": sql.periodic_report("documents"),
        "op13_lexical_search": sql.search_report("documents", "benchmark"),
    }
