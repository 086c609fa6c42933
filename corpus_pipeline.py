"""A corpus pipeline: each stage reads what its predecessor kept and its decisions take effect.

Near duplicates here are texts whose sets of five-word shingles agree to 80 % or more; one of each
group stays. Defined cases are those of the operators: null and empty texts fail the quality rules
and go; rows without id stay in the near-duplicate stage; repeated rows are judged one by one;
extra columns are carried along whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import decontamination, jaccard_join, line_dedup, line_quality, source_mix, sql
from basketry.llm.frames import stored, table

SHINGLE, PERCENT = 5, 80  # of the near-duplicate stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_quality.clean(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.rewrite(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.clean(docs, k=SHINGLE, percent=PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.report(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix_stage),
]

ORACLE_SQL = sql.pipeline(SHINGLE, PERCENT)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
