"""Profiles, counts, duplicate rates and alerts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.aggregates import n_distinct
from basketry.functions.dates import Moment, moment, on_day
from basketry.schemas import VERSION


def profile(df: DataFrame, sample: int = 3) -> tuple[DataFrame, DataFrame]:
    """Row count, and the first few rows."""
    return df.agg(F.count(F.lit(1)).alias("row_count")), df.limit(sample)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def duplicate_rate(key: Column, approx: bool = False) -> Column:
    """Percentage of rows repeating a key: half-even rounded, 0 for no rows."""
    unique = F.try_divide(n_distinct(key, approx), F.count(key))
    return F.coalesce(F.bround((1 - unique) * 100), F.lit(0)).cast("short")


def duplicate_report(
    raw: Mapping[str, tuple[DataFrame, str]],
    as_of: Moment,
    version: str = VERSION,
    approx: bool = False,
) -> DataFrame:
    """One row: duplicate rate per entity among the rows that came in on the day of ``as_of``.

    ``raw`` maps an entity name to its table and key column. The per-entity one-row results are
    stacked and folded, which needs neither a join nor a common key type.
    """
    rates = [
        df.filter(on_day(F.col(version), as_of))
        .agg(duplicate_rate(F.col(key), approx).alias("rate"))
        .select(F.lit(name).alias("entity"), "rate")
        for name, (df, key) in raw.items()
    ]
    stacked = reduce(DataFrame.unionAll, rates)
    folded = stacked.agg(
        *(F.max(F.when(F.col("entity") == n, F.col("rate"))).alias(f"duplicate_{n}") for n in raw)
    )
    return folded.select(F.date_trunc("day", moment(as_of)).alias("event_time"), "*")


def duplicate_alerts(report: DataFrame, threshold: int = 50) -> DataFrame:
    """Long form of the report, only the entities above the threshold."""
    entities = [c for c in report.columns if c.startswith("duplicate_")]
    long = report.unpivot(["event_time"], entities, "entity", "rate")
    return long.filter(F.col("rate") > threshold)
