"""Masking of personal fields at any depth, driven by the schema."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.masking import mask_email, mask_phone
from basketry.schemas import SENSITIVE

# Personal data as it stands in text that cannot be parsed.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+"
PHONE = r"\+?[0-9][0-9 ()-]{8,}[0-9]"

_MASKS: dict[str, Callable[[Column], Column]] = {"phone": mask_phone, "email": mask_email}


def mask_nested(df: DataFrame, patterns: Sequence[str] = ("phone", "email")) -> DataFrame:
    """Mask text fields whose name contains a pattern (first pattern wins), at any depth.

    Works out from the schema which columns hold such a field and rewrites only those, so the
    result is one static projection.
    """
    changed = {}
    for field in df.schema:
        masked = _mask(F.col(f"`{field.name}`"), field, patterns)
        if masked is not None:
            changed[field.name] = masked
    return df.withColumns(changed) if changed else df


def mask_topic(df: DataFrame, topic: str, sensitive: Collection[str] = SENSITIVE) -> DataFrame:
    return mask_nested(df) if topic in sensitive else df


# A JSON string without its quotes; possessive, as values can be long.
_STRING = r'[^"\\]*+(?:\\.[^"\\]*+)*+'


def replace_matches(col: Column, pattern: str, change: Callable[[Column], Column]) -> Column:
    """A text with every match of a pattern changed by an expression, the rest left as it is."""
    between = F.split(col, pattern, -1)
    found = F.regexp_extract_all(col, F.lit(pattern), 0)
    changed = F.zip_with(
        between, found, lambda b, m: F.concat(b, F.when(m.isNull(), "").otherwise(change(m)))
    )
    return F.array_join(changed, "")


def mask_json(col: Column, patterns: Sequence[str] = ("phone", "email")) -> Column:
    """A JSON text with the values masked whose key contains a pattern (first pattern wins).

    Works on the text, at any depth and without a schema, so everything else stays as it was
    written. Strings, numbers and lists of them are masked; objects under such a key are not,
    their own keys are. Keys written with escapes are not recognised.
    """
    for i, name in enumerate(patterns):
        others = "".join(f'(?![^"]*{p})' for p in patterns[:i])
        scalar = rf'"{_STRING}"|-?[0-9][0-9.eE+-]*+'
        key = rf'"{others}[^"\\]*{name}[^"\\]*"\s*+:\s*+'
        whole = rf"(?i){key}(?:{scalar}|\[(?:\s*+(?:{scalar})\s*+,?+)*+\])"

        def masked(value: Column, mask=_MASKS[name]) -> Column:
            text = F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<string>")[0]
            return F.to_json(F.array(mask(text))).substr(F.lit(2), F.length(F.to_json(F.array(mask(text)))) - 2)

        def hidden(match: Column, key=key, scalar=scalar, masked=masked) -> Column:
            head = F.regexp_extract(match, f"(?i)^({key})", 1)
            body = match.substr(F.length(head) + 1, F.length(match))
            return F.concat(head, replace_matches(body, scalar, masked))

        col = replace_matches(col, whole, hidden)
    return col


def mask_text(col: Column) -> Column:
    """Text with e-mail addresses and phone numbers blanked out, whatever they stand in."""
    return F.regexp_replace(F.regexp_replace(col, EMAIL, "***@***"), PHONE, "***")


def _mask(col: Column, field: T.StructField, patterns: Sequence[str]) -> Column | None:
    """The masked column, or None where nothing below ``field`` needs masking."""
    kind = field.dataType
    if isinstance(kind, T.StringType):
        hit = next((p for p in patterns if p in field.name.lower()), None)
        return _MASKS[hit](col) if hit else None
    if isinstance(kind, T.StructType):
        return _mask_struct(col, kind, patterns)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        element = kind.elementType
        if not _holds_personal(element, patterns):
            return None
        return F.transform(col, lambda item: _mask_struct(item, element, patterns))
    return None


def _mask_struct(col: Column, kind: T.StructType, patterns: Sequence[str]) -> Column | None:
    masked = None
    for inner in kind:
        value = _mask(col.getField(inner.name), inner, patterns)
        if value is not None:
            masked = (col if masked is None else masked).withField(f"`{inner.name}`", value)
    return masked


def _holds_personal(kind: T.DataType, patterns: Sequence[str]) -> bool:
    if isinstance(kind, T.ArrayType):
        return isinstance(kind.elementType, T.StructType) and _holds_personal(
            kind.elementType, patterns
        )
    if isinstance(kind, T.StructType):
        return any(
            (isinstance(f.dataType, T.StringType) and any(p in f.name.lower() for p in patterns))
            or _holds_personal(f.dataType, patterns)
            for f in kind
        )
    return False
