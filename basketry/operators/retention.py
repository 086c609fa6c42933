"""Retention by age."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import Moment, days_before, month_key


def retain(
    df: DataFrame, ts: str, days: int, as_of: Moment, month: str | None = None
) -> DataFrame:
    """Rows not older than ``days``. With ``month`` (a ``yyyyMM`` partition column) whole
    partitions before the limit are skipped without being read."""
    start = days_before(as_of, days)
    kept = df.filter(F.col(ts) >= start)
    return kept.filter(F.col(month).cast("string") >= month_key(start)) if month else kept
