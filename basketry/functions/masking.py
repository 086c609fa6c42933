"""Personal-data expressions: normalise, then hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def normalize_phone(col: Column) -> Column:
    """Digits and ``+`` only; a leading 8, a leading 7 of a number without ``+``, or nothing
    before ten characters becomes ``+7``. Alternatives apply in that order."""
    kept = F.regexp_replace(col, r"[^\p{Nd}+]", "")
    return F.regexp_replace(kept, r"^(?:8|7(?!.*\+)|(?=.{10}\z))", "+7")


def normalize_email(col: Column) -> Column:
    return F.lower(F.btrim(col, F.lit(_BLANKS)))


def hash_value(col: Column) -> Column:
    """md5 hex of the text; blank and missing values stay as they are."""
    return F.when(col != "", F.md5(col)).otherwise(col)


def mask_phone(col: Column) -> Column:
    return hash_value(normalize_phone(col))


def mask_email(col: Column) -> Column:
    return hash_value(normalize_email(col))
