"""Left lookups into reference tables, required keys and row validity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.clean import clean_trim
from basketry.operators.dedup import latest_by_key


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[Column, str]],
    take: Mapping[str, str],
    null_safe: bool = False,
    unique: bool = True,
    prefer: Sequence[Column] = (),
) -> DataFrame:
    """Left equi-join that adds ``take`` (right column -> new name) to ``left``.

    ``on`` pairs an expression over ``left`` with a column of ``right``; ``null_safe`` lets NULL
    meet NULL, still as a hashable key. Where ``on`` is not a key of ``right`` pass
    ``unique=False``: one row per key is kept, the one greatest by ``prefer``, so the join
    never multiplies rows of ``left``.
    """
    keys = [f"_key{i}" for i in range(len(on))]
    side = right.select(
        *(F.col(r).alias(k) for k, (_, r) in zip(keys, on, strict=True)),
        *(c.alias(f"_prefer{i}") for i, c in enumerate(prefer)),
        *(F.col(c).alias(name) for c, name in take.items()),
    )
    if not null_safe:
        side = side.dropna(subset=keys)
    if not unique:
        order = [f"_prefer{i}" for i in range(len(prefer))] or list(take.values())
        side = latest_by_key(side, keys, order)
    side = side.select(*keys, *take.values())
    probes = [f"_probe{i}" for i in range(len(on))]
    left = left.withColumns({p: expr for p, (expr, _) in zip(probes, on, strict=True)})
    cond = [
        F.col(p).eqNullSafe(F.col(k)) if null_safe else F.col(p) == F.col(k)
        for p, k in zip(probes, keys, strict=True)
    ]
    return left.join(side, cond, "left").drop(*probes, *keys)


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Rows in which every named text column holds more than blanks."""
    for col in cols:
        df = df.filter(clean_trim(F.col(col)).isNotNull())
    return df


def require_any(df: DataFrame, *cols: str) -> DataFrame:
    """Rows in which at least one named text column holds more than blanks."""
    return df.filter(F.coalesce(*(clean_trim(F.col(c)) for c in cols)).isNotNull())


def split_valid_rows(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Typed rows with all required columns set, and the rejects with the columns they lack."""
    lacking = F.concat_ws(",", *(F.when(F.col(c).isNull(), F.lit(c)) for c in required))
    return df.dropna(subset=list(required)), df.withColumn("reason", lacking).filter(
        F.col("reason") != ""
    )


def plausible_dates(df: DataFrame, birth: str, registered: str) -> DataFrame:
    """Rows registered after birth; unknown dates fail the test."""
    return df.filter(F.to_date(registered) > F.col(birth))
