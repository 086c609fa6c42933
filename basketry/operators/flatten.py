"""Nested documents to flat RAW rows, with the column list derived from the document schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.clean import or_blank
from basketry.schemas import VERSION, text_schema

LABEL_SEPARATOR = ", "


def join_labels(col: Column, sep: str = LABEL_SEPARATOR) -> Column:
    return F.array_join(col, sep)


def as_json(col: Column) -> Column:
    return F.to_json(col)


def to_raw_string(col: Column) -> Column:
    return col.cast("string")


def leaf_columns(kind: T.StructType, root: Column | None = None, prefix: str = "") -> list[Column]:
    """One text column per leaf, named after its path: ``a.b.c`` becomes ``a_b_c``.

    A list of texts is joined; of a list of objects the first element is taken.
    """
    leaves: list[Column] = []
    for field in kind:
        col = F.col(f"`{field.name}`") if root is None else root.getField(field.name)
        name = f"{prefix}{field.name}"
        inner = field.dataType
        if isinstance(inner, T.ArrayType) and isinstance(inner.elementType, T.StructType):
            col, inner = F.get(col, F.lit(0)), inner.elementType
        if isinstance(inner, T.StructType):
            leaves += leaf_columns(inner, col, f"{name}_")
        elif isinstance(inner, T.ArrayType):
            leaves.append(join_labels(col).alias(name))
        else:
            leaves.append(to_raw_string(col).alias(name))
    return leaves


def object_lists(kind: T.StructType) -> list[str]:
    return [
        f.name
        for f in kind
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)
    ]


def text_lists(kind: T.StructType) -> list[str]:
    return [
        f.name
        for f in kind
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType)
    ]


def flatten(
    envelopes: DataFrame,
    shape: str | T.StructType,
    items: str = "all",
    missing: str | None = None,
    keep_json: bool = True,
    also: Sequence[str] = (),
) -> DataFrame:
    """RAW rows of one entity (or document schema) from envelopes ``(json_data, event_time[, doc])``.

    ``items="all"`` also keeps the whole item list next to the first-item columns, and every list
    of texts as ``<name>_list`` next to its joined form, so nothing of a document is lost and RAW
    stays one row per document. ``missing=""`` writes blanks for NULL; ``also`` names columns of the
    envelopes to carry along.
    """
    schema = text_schema(shape) if isinstance(shape, str) else shape
    if "doc" not in envelopes.columns:
        envelopes = envelopes.withColumn("doc", F.from_json("json_data", schema))
    leaves = leaf_columns(schema, F.col("doc"))
    if missing is not None:
        names = envelopes.select(*leaves).columns
        leaves = [or_blank(c).alias(n) for c, n in zip(leaves, names, strict=True)]
    lists = []
    if items == "all":
        lists += [F.col(f"doc.{name}") for name in object_lists(schema)]
        lists += [F.col(f"doc.{name}").alias(f"{name}_list") for name in text_lists(schema)]
    service = [F.col("json_data")] if keep_json else []
    return envelopes.select(*service, F.col(VERSION), *leaves, *lists, *also)


def explode_items(df: DataFrame, array: str = "items", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per element of an array of objects; rows with an empty or missing array vanish."""
    return df.select(*keep, F.explode(array).alias("_item")).select(*keep, "_item.*")
