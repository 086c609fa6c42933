"""Distinct counts that add up: a sketch per day and key column, merged over any period.

A sketch of ``2**SKETCH_SIZE`` registers is a few KB whatever it counts, so the days of a year are
merged without reading a row again. The estimate is within ``BOUND`` of the exact count (three
standard errors of the sketch), small counts are exact or off by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_SIZE = 12
BOUND = 0.05


def daily_sketches(df: DataFrame, key: str, ts: str) -> DataFrame:
    """``day, n_keys, sketch``: how many rows of a day have the key, and the sketch of its values."""
    return df.groupBy(F.to_date(ts).alias("day")).agg(
        F.count(key).alias("n_keys"), F.hll_sketch_agg(key, SKETCH_SIZE).alias("sketch")
    )


def merged(sketches: DataFrame, *by: Column) -> DataFrame:
    """Days put together: ``by``, rows with the key, estimated distinct keys."""
    return sketches.groupBy(*by).agg(
        F.sum("n_keys").alias("n_keys"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"),
    )


def estimated_duplicate_rate(n_keys: Column, n_distinct: Column) -> Column:
    """Percentage of rows repeating a key, from the merged counts; 0 for no rows."""
    unique = F.least(F.try_divide(n_distinct, n_keys), F.lit(1.0))
    return F.coalesce(F.bround((1 - unique) * 100), F.lit(0)).cast("short")


def within_bound(estimate: Column, exact: Column, bound: float = BOUND) -> Column:
    return F.abs(estimate - exact) <= F.greatest(exact * bound, F.lit(1))
