"""Small helpers on frames of documents."""

from __future__ import annotations

from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import scratch_dir
from basketry.sources import files
from basketry.streaming.log import release

# The white space that ends a word, as characters and as a class.
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Hand texts to Python in Arrow batches of so many rows: fewer bytes at once on either side."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame, written to the shared scratch folder and read again: lineage ends there."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[found] = path
    return found


def discard(*frames: DataFrame) -> None:
    """Delete stored frames that no later step reads, and the shuffles that only dead plans name."""
    for df in frames:
        if path := _FOLDERS.pop(df, None):
            files.delete(df.sparkSession, path)
    release(frames[0].sparkSession)


def small(df: DataFrame, rows: int) -> DataFrame:
    """A stored frame of narrow rows, to be broadcast if it counts so few rows."""
    return F.broadcast(df) if df.count() <= rows else df


def text_key(text: str = "text") -> Column:
    """64 bits of the text; with the document id it tells rows apart that share an id."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, SMALL)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression over a value that is computed once, however often the expression names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, combine: Callable[[Column, Column], Column], zero: Column, chunk: int = 256) -> Column:
    """For each element of an array of numbers the combination of all elements before it.

    Done in chunks and over the chunks, as a fold that appends copies its array at every step.
    """

    def scan(xs: Column) -> Column:
        none = F.array().cast("array<int>")
        step = lambda s, x: F.struct(combine(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
        return F.aggregate(xs, F.struct(zero.cast("int").alias("at"), none.alias("out")), step, lambda s: s["out"])

    def of_chunks(chunks: Column) -> Column:
        whole = F.transform(chunks, lambda c: F.aggregate(c, zero.cast("int"), combine))
        return F.flatten(F.zip_with(chunks, scan(whole), lambda c, before: F.transform(scan(c), lambda x: combine(before, x))))

    def cut(xs: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(xs) / chunk).cast("int"), F.lit(1)) - 1)
        return bound(F.transform(numbers, lambda k: F.slice(xs, k * chunk + 1, F.lit(chunk))), of_chunks)

    return bound(values.cast("array<int>"), cut)


def packed(docs: DataFrame) -> DataFrame:
    """``doc, k_id, k_hash``: the documents in one column, so no name of theirs meets another, and
    what tells a row apart."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col("doc_id").alias("k_id"), text_key().alias("k_hash"))


def without_lines(text: Column, gone: Column) -> Column:
    """The text without the lines at these places (an array of numbers from 0)."""

    def left(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone.cast("array<int>"))
        return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")

    return bound(F.split(text, "\n", -1), left)


def unpacked(rows: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The columns of the packed documents with another text, and its length where they carry one."""
    changed = rows.select(F.col("doc").withField("text", text).alias("doc"))
    if "n_chars" in docs.columns:
        size = F.char_length("doc.text").cast(docs.schema["n_chars"].dataType)
        changed = changed.select(F.col("doc").withField("n_chars", size).alias("doc"))
    return changed.select("doc.*")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
