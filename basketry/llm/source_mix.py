"""Mixing sources to target weights: exact budgets cut by distributed prefix sums.

Every row gets a hash-random key. Rows are sorted by key within ranges of keys, ranges within
their source; the words before a row are the words of the lower ranges plus those before it in its
own range. A source's budget is its whole epochs plus a rest; the rest is cut from the prefix sums
to the word. A hot source is spread over all its ranges, so no task holds a source.

Defined cases: null text has no words; null source is a source of its own, ranked last; rows that
repeat in full each count and take the same place in any order; null ids sort first within equal
keys; without words all targets are 0; an empty table gives an empty result. Only ``doc_id``,
``text`` and ``source`` are read, whatever other columns are there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.llm.frames import WORD

RANGE_DIGITS = 3  # hexadecimal digits of the key that name a range: 4096 ranges for a source
MOST_EPOCHS = 3


def source_targets(sizes: DataFrame, cycle: int = 3, most: int = MOST_EPOCHS) -> DataFrame:
    """``source, source_size, target``: one row for each source, from ``source, source_size``.

    Weights run 1..cycle over the sources by code point. A level L gives each source the lesser of
    ``weight * L`` and ``most`` times its size; L is where these add up to all words. Resharing the
    excess by weight until none is above ends at the same level.
    """
    ranked = sizes.withColumn("weight", (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % cycle + 1)
    by_room = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    full = ranked.select(
        "*",
        F.sum("source_size").over(W.partitionBy()).alias("total"),
        F.coalesce(F.sum("source_size").over(by_room.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("below"),
        F.sum("weight").over(by_room.rowsBetween(0, W.unboundedFollowing)).alias("rest"),
    )
    # The level if every source with less room than this one is full and no other is. It rises up to
    # the first source that is not overfilled by it, the one sought, and falls from there.
    level = (F.col("total") - most * F.col("below")) / F.col("rest")
    fits = full.withColumn("level", F.when(level * F.col("weight") <= most * F.col("source_size"), level))
    found = fits.withColumn("level", F.max("level").over(W.partitionBy()))
    target = F.least(F.col("level") * F.col("weight"), (most * F.col("source_size")).cast("double"))
    return found.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, seed: str = "mix", cycle: int = 3, most: int = MOST_EPOCHS) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, epochs, rest_words`` for each document.

    ``taken`` is ``epochs`` whole readings plus the first ``rest_words`` words of one more.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    rows = docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("key"), F.xxhash64("text").alias("text_hash")
    ).withColumn("part", F.substring("key", 1, RANGE_DIGITS))
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
    before = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(
        "source", "part", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before")
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = parts.alias("p").join(source_targets(sizes, cycle, most).alias("t"), F.expr("p.source <=> t.source")).select(
        F.col("p.source").alias("p_source"), F.col("p.part").alias("p_part"), "before", "source_size", "target"
    )
    inner = W.partitionBy("source", "part").orderBy("key", "doc_id", "size", "text_hash").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.select("*", F.coalesce(F.sum("size").over(inner), F.lit(0)).alias("inner")).join(
        plan, F.expr("source <=> p_source AND part = p_part")
    )
    budget = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(0).cast("long")
    rest = budget - F.col("epochs") * F.col("source_size")
    cut = F.least(F.greatest(rest - F.col("before") - F.col("inner"), F.lit(0)), F.col("size")).cast("long")
    return placed.withColumn("epochs", whole).withColumn("rest_words", cut).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("rest_words")).alias("taken"), "epochs", "rest_words", "text_hash"
    )


def report(docs: DataFrame) -> DataFrame:
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")
