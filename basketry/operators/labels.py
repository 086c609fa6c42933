"""Parsing a joined label text back into an array, and unnesting arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A label is a capital letter and the run of lower-case letters, digits, spaces,
# ampersands and commas after it.
LABEL_PATTERN = r"([А-ЯЁA-Z][а-яё0-9\s&,]*|[A-Z][a-z0-9\s&,]*)"


def extract_labels(col: Column, pattern: str = LABEL_PATTERN) -> Column:
    return F.regexp_extract_all(col, F.lit(pattern), 1)


def tidy_labels(labels: Column) -> Column:
    """Trim each label and drop the commas left at its end."""
    return F.transform(labels, lambda x: F.regexp_replace(F.trim(x), r",+\z", ""))


def drop_blank(labels: Column) -> Column:
    return F.filter(labels, lambda x: x != "")


def unnest(df: DataFrame, array: str | Column, alias: str) -> DataFrame:
    """One row per array element; rows with an empty or missing array vanish.

    Pass a computed array as the expression itself: exploding a column computed before lets
    Catalyst infer a filter on it, which computes it again.
    """
    return df.withColumn(alias, F.explode(array))
