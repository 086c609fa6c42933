"""Folders of JSON documents, one sub-folder per entity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.schemas import CORRUPT, ENTITIES, document_schema


def _read(spark: SparkSession, path: str, entity: str, multi_line: bool) -> DataFrame:
    schema = T.StructType([*document_schema(entity), T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def _unreadable(entity: str) -> Column:
    """Nothing at all could be read. A single odd field only leaves that field NULL.

    The fields are counted, as null tests would be pushed into the reader, which then skips a
    broken document for the fields before its fault.
    """
    fields = (F.col(f"`{f.name}`").isNotNull().cast("int") for f in document_schema(entity))
    nothing = reduce(Column.__add__, fields) == 0
    return F.col(CORRUPT).isNotNull() & nothing


def read_entity(
    spark: SparkSession, path: str, entity: str, multi_line: bool = True
) -> DataFrame:
    """Documents of one entity. ``multi_line`` is one document per file; off is one per line,
    the layout to use for large volumes since such files split."""
    return _read(spark, path, entity, multi_line).filter(~_unreadable(entity)).drop(CORRUPT)


def read_unreadable(
    spark: SparkSession, path: str, entity: str, multi_line: bool = True
) -> DataFrame:
    """File and text of the documents ``read_entity`` skips."""
    bad = _read(spark, path, entity, multi_line).filter(_unreadable(entity))
    return bad.select(F.col("_metadata.file_path").alias("file"), F.col(CORRUPT).alias("text"))


def _texts(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """``file, text, broken`` of the files, or of their lines; blank ones are left out."""
    rows = spark.read.text(path, wholetext=multi_line).select(
        F.col("_metadata.file_path").alias("file"), F.trim("value", F.lit(" \t\r\n\ufeff")).alias("text")
    )
    # Only objects and lists of them are documents.
    shaped = F.col("text").startswith("{") | F.col("text").startswith("[")
    parsed = F.try_parse_json("text").isNotNull() & shaped
    return rows.filter(F.col("text") != "").withColumn("broken", ~F.coalesce(parsed, F.lit(False)))


def read_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The documents under ``path`` as the JSON texts they came in, whatever fields they have.

    Nothing is typed, so unknown fields and values of an unexpected kind are kept. A file (or line)
    that is a list gives a document for each element.
    """
    good = _texts(spark, path, multi_line).filter(~F.col("broken"))
    elements = F.transform(
        F.try_parse_json("text").try_cast("array<variant>"), lambda v: F.to_json(v)
    )
    listed = F.when(F.col("text").startswith("["), elements).otherwise(F.array("text"))
    return good.select(F.explode(listed).alias("text"))


def read_broken(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``file, text`` of what ``read_documents`` leaves out, as it is no JSON document."""
    return _texts(spark, path, multi_line).filter("broken").select("file", "text")


def load_all(
    spark: SparkSession,
    base: str,
    out: str,
    entities: Sequence[str] = ENTITIES,
    mode: str = "overwrite",
    multi_line: bool = True,
) -> None:
    """Full refresh: replace the stored copy of every entity by what lies under ``base``."""
    for entity in entities:
        docs = read_entity(spark, f"{base}/{entity}", entity, multi_line)
        docs.write.mode(mode).parquet(f"{out}/{entity}")
