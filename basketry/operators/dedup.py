"""Newest row per key, upsert, union and distinct labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.schemas import VERSION


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    version: str | Sequence[str] = VERSION,
    required: Sequence[str] = (),
) -> DataFrame:
    """The row with the greatest version per key; equal versions fall back to the other columns.

    An aggregate rather than a window: every map task sends at most one row per key, so a key
    owning much of the table costs no more than any other. NULL keys form one group. Only rows with
    all ``required`` columns count: tested inside the aggregate, as a filter would be pushed below
    the expressions that make these columns and compute them twice.
    """
    versions = [version] if isinstance(version, str) else list(version)
    rest = [c for c in df.columns if c not in keys and c not in versions]
    if required:
        whole = reduce(Column.__and__, (F.col(c).isNotNull() for c in required))
        packed = F.max(F.when(whole, F.struct(*versions, *rest))).alias("_row")
        newest = df.groupBy(*keys).agg(packed).filter(F.col("_row").isNotNull())
        newest = newest.select(*keys, "_row.*")
    elif not rest and len(versions) == 1:
        newest = df.groupBy(*keys).agg(F.max(versions[0]).alias(versions[0]))
    else:
        packed = F.max(F.struct(*versions, *rest)).alias("_row")
        newest = df.groupBy(*keys).agg(packed).select(*keys, "_row.*")
    return newest.select(*df.columns)


def upsert_latest(
    existing: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    version: str | Sequence[str] = VERSION,
) -> DataFrame:
    """Existing rows and a batch, newest row per key. Applying a batch twice changes nothing."""
    both = batch if existing is None else union_sources(existing, batch)
    return latest_by_key(both, keys, version)


def union_sources(*dfs: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def distinct_labels(df: DataFrame, col: str, version: str = VERSION) -> DataFrame:
    """Distinct values of one column with the newest version each was seen at."""
    return latest_by_key(df.select(col, version), [col], version)


def head(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)
