"""Cleaning and typing expressions over RAW text columns."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Emoji code-point ranges, the five label emoji, characters kept in labels.
EMOJI_RANGES = (
    r"\x{1F300}-\x{1F5FF}\x{1F900}-\x{1F9FF}\x{2600}-\x{26FF}\x{2700}-\x{27BF}\x{FE00}-\x{FE0F}"
)
LABEL_EMOJI = "🍏🥦🥩🥖🥛"
NOT_WORD_CHARS = r"[^\p{L}\p{N}\s,]+"
TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")

MONEY = "decimal(16,2)"


def clean_text(col: Column) -> Column:
    """Trimmed lower-case text, NULL where blank."""
    return F.nullif(F.lower(F.trim(col)), F.lit(""))


def clean_trim(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def or_blank(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def strip_emoji(col: Column, anchored: bool = False, literal: bool = False) -> Column:
    """Drop emoji: by code-point range or only the label emoji; anywhere or only at the start."""
    klass = LABEL_EMOJI if literal else EMOJI_RANGES
    return F.regexp_replace(col, f"{'^' if anchored else ''}[{klass}]+", "")


def keep_word_chars(col: Column) -> Column:
    return F.regexp_replace(col, NOT_WORD_CHARS, "")


def clean_label(col: Column) -> Column:
    """A category label reduced to its key form: no emoji, trimmed, lower case."""
    return clean_text(strip_emoji(col))


@F.pandas_udf(StringType())
def _nfc(texts: pd.Series) -> pd.Series:
    return texts.str.normalize("NFC")


def nfc(col: Column) -> Column:
    """Unicode NFC form. Spark has no built-in for it, hence an Arrow function; opt-in."""
    return _nfc(col)


def to_double(col: Column) -> Column:
    return clean_trim(col).try_cast("double")


def to_float(col: Column) -> Column:
    return clean_trim(col).try_cast("float")


def to_int(col: Column) -> Column:
    return clean_trim(col).try_cast("int")


def to_short(col: Column, default: int | None = 0) -> Column:
    value = clean_trim(col).try_cast("short")
    return value if default is None else F.coalesce(value, F.lit(default).cast("short"))


def to_money(col: Column, strict: bool = False) -> Column:
    """Two-decimal amount; digits beyond the second are dropped, not rounded.

    ``strict`` fails the job on unparseable text instead of giving NULL.
    """
    trimmed = clean_trim(col)
    text = F.regexp_replace(trimmed, r"(\.\d\d)\d+\z", "$1")
    # Amounts with an exponent have their digits at another place: cut by value instead.
    wide = trimmed.try_cast("decimal(38,18)")
    cut = F.when(wide >= 0, F.floor(wide, F.lit(2))).otherwise(F.ceil(wide, F.lit(2))).cast("string")
    text = F.when(trimmed.rlike(r"^[+-]?\d*\.?\d+[eE][+-]?\d+\z") & cut.isNotNull(), cut).otherwise(text)
    return text.cast(MONEY) if strict else text.try_cast(MONEY)


def to_date_or_null(col: Column) -> Column:
    return F.try_to_date(clean_trim(col), "yyyy-MM-dd")


# Shapes of a moment beside ISO 8601, tried in this order: what the text must look like, and the
# pattern that reads it. Two numbers before a year are day and month; month and day only where the
# second could be no month.
_CLOCK = r"(?:[ T]\d{1,2}:\d{2}(?::\d{2})?)?"
_TIMES = "[[ ]['T']H:mm[:ss]]"
MOMENTS = (
    (rf"^\d{{4}}[/.]\d{{1,2}}[/.]\d{{1,2}}{_CLOCK}$", f"yyyy-M-d{_TIMES}"),
    (rf"^\d{{1,2}}[/.-]\d{{1,2}}[/.-]\d{{4}}{_CLOCK}$", f"d-M-yyyy{_TIMES}"),
    (rf"^\d{{1,2}}[/.-](?:1[3-9]|2\d|3[01])[/.-]\d{{4}}{_CLOCK}$", f"M-d-yyyy{_TIMES}"),
    (rf"^\d{{1,2}} [A-Za-z]{{3}} \d{{4}}{_CLOCK}$", f"d MMM yyyy{_TIMES}"),
    (rf"^[A-Za-z]{{3}} \d{{1,2}}, \d{{4}}{_CLOCK}$", f"MMM d, yyyy{_TIMES}"),
    (r"^(?:19|20)\d{6}$", "yyyyMMdd"),
    (r"^(?:19|20)\d{12}$", "yyyyMMddHHmmss"),
)
# Digits of a whole number that counts from 1970: seconds, thousandths, millionths.
EPOCHS = ((9, 10, 1), (12, 13, 1_000), (15, 16, 1_000_000))


def best_effort_ts(col: Column) -> Column:
    """A moment written in any of the usual ways, NULL where it is none of them.

    ISO 8601 first; then whole numbers by their count of digits; then ``MOMENTS`` in order. So
    03/04/2025 is the third of April, 03/25/2025 the 25th of March, 20250403 a day and
    1743638400 a count of seconds.
    """
    text = clean_trim(col)
    iso = F.when(text.rlike(r"^\d{4}-"), F.try_to_timestamp(text))
    # The other shapes are rare: as a function of an array element their text is computed once,
    # which keeps the generated code of the common case small.
    return F.coalesce(iso, F.get(F.transform(F.array(text), _other_moment), F.lit(0)))


def _other_moment(text: Column) -> Column:
    separated = F.regexp_replace(text, r"(?<=^\d{1,4})[/.](\d{1,2})[/.](?=\d)", "-$1-")
    number = text.try_cast("decimal(18,0)")
    counted = [
        F.when(
            text.rlike(rf"^\d{{{least},{most}}}$"),
            F.timestamp_micros((number * (1_000_000 // unit)).cast("long")),
        )
        for least, most, unit in EPOCHS
    ]
    written = [
        F.when(text.rlike(shape), F.try_to_timestamp(separated, F.lit(pattern)))
        for shape, pattern in MOMENTS
    ]
    return F.coalesce(*counted, *written)


def to_ts(col: Column, strict: bool = False) -> Column:
    """A moment, read by best effort. ``strict`` takes ISO 8601 only and fails on other text."""
    return clean_trim(col).cast("timestamp") if strict else best_effort_ts(col)


def to_bool(col: Column) -> Column:
    """True for the word ``true`` only; anything else, also missing, is false."""
    return F.coalesce(clean_text(col) == "true", F.lit(False))


def to_bool3(col: Column) -> Column:
    """True, false, or NULL for words that are neither."""
    word = clean_text(col)
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def to_enum(col: Column, values: Sequence[str]) -> Column:
    word = clean_text(col)
    return F.when(word.isin(*values), word)


def fixed_len(col: Column, size: int) -> Column:
    text = F.trim(col)
    return F.when(F.length(text) == size, text)


def null_of(kind: str) -> Column:
    return F.lit(None).cast(kind)


def surrogate_key(*cols: Column) -> Column:
    """64-bit key over the parts. NULL parts count as blank, since the hash would skip them."""
    return F.xxhash64(*(or_blank(c.cast("string")) for c in cols))


def coalesce_key(col: Column, missing: int = 0) -> Column:
    return F.coalesce(col, F.lit(missing).cast("long"))
