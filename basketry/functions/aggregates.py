"""Aggregate expressions behind the customer flags.

All of them have fixed-width partial states, so a customer holding a large share of the rows
shrinks to one partial row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ever(cond: Column, null_as: bool | None = None) -> Column:
    """The condition held at least once; NULL conditions are ignored or read as ``null_as``."""
    return F.max(cond if null_as is None else F.coalesce(cond, F.lit(null_as)))


def never(cond: Column) -> Column:
    """The condition never held; NULL if it was never known."""
    return ~F.max(cond)


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def sum_where(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def mean(value: Column) -> Column:
    return F.avg(value)


def share(cond: Column, of: Column | None = None) -> Column:
    """Part of the rows (or of the non-NULL ``of``) for which the condition held."""
    return F.try_divide(F.count_if(cond), F.count(F.lit(1) if of is None else of))


def n_distinct(value: Column, approx: bool = False) -> Column:
    return F.approx_count_distinct(value) if approx else F.count_distinct(value)


def n_distinct_where(cond: Column, value: Column) -> Column:
    return F.count_distinct(F.when(cond, value))


def several(value: Column) -> Column:
    """More than one distinct value. Smallest against largest needs no set of values."""
    return F.min(value) != F.max(value)


def one_only(value: Column) -> Column:
    return F.min(value) == F.max(value)


def as_flag(cond: Column) -> Column:
    return cond.cast("int")
