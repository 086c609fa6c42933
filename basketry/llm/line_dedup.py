"""Line dedup through sharded minimal perfect hashes over the hashes of repeated lines.

Lines are hashed to 128 bits. Hashes found in enough documents are counted (pre-aggregated, so a
line that a third of the documents hold is one row of each map task) and dealt to shards. Each
shard becomes one row: a minimal perfect hash (a few levels of bit vectors with ranks) that
numbers its hashes, and arrays of fingerprints, counts and keeper ids by that number. Documents
send their line hashes to the shards and probe the arrays in numpy; no line is joined with a line.
A shard with many probes is copied and its probes salted, so no task holds a hot line.

Rarer lines are not in the index: they cannot lose anything, and the fingerprint turns them away.

Defined cases: null and empty text is one empty line, which is below the length limit and stays;
rows that share a doc_id are one document in the counts; rows without doc_id are one document
together, which is never the keeper of a line that others hold; repeated rows each get their
result; an empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.frames import SPACE_CHARS, ascii_lower, packed, parallelism, stored, text_key, unpacked, without_lines
from basketry.llm.textual import mixed

MIN_CHARS = 20
MIN_DOCS = 3
PROBES_PER_TASK = 200_000
GAMMA = 2  # bits of a level for each hash that reaches it
NO_ID = -(2**63)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


def places(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    return (mixed(hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(bits)).astype(np.int64)


def build_levels(hashes: np.ndarray) -> list[np.ndarray]:
    """Bit vectors of a minimal perfect hash: hashes alone at their place stay at a level."""
    levels, left = [], hashes
    while len(left):
        bits = max(64, GAMMA * len(left))
        at = places(left, len(levels), bits)
        alone = np.bincount(at, minlength=bits) == 1
        levels.append(alone)
        left = left[~alone[at]]
    return levels


def numbers(levels: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """The number of each hash, -1 where no level has a place for it."""
    found, base = np.full(len(hashes), -1, np.int64), 0
    open_ = np.arange(len(hashes))
    for k, bits in enumerate(levels):
        at = places(hashes[open_], k, len(bits))
        hit = bits[at]
        rank = np.cumsum(bits) - 1
        found[open_[hit]] = base + rank[at[hit]]
        base += int(bits.sum())
        open_ = open_[~hit]
    return found


def pack(levels: list[np.ndarray]) -> tuple[bytes, bytes]:
    sizes = np.array([len(x) for x in levels], np.int64)
    return sizes.tobytes(), b"".join(np.packbits(x).tobytes() for x in levels)


def unpack(sizes: bytes, bits: bytes) -> list[np.ndarray]:
    levels, at, raw = [], 0, np.frombuffer(bits, np.uint8)
    for n in np.frombuffer(sizes, np.int64):
        width = (int(n) + 7) // 8
        levels.append(np.unpackbits(raw[at : at + width], count=int(n)).astype(bool))
        at += width
    return levels


def index_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """One row for the hashes of a shard."""
    h = rows["h"].to_numpy(np.int64).view(np.uint64)
    levels = build_levels(h)
    order = np.empty(len(h), np.int64)
    order[numbers(levels, h)] = np.arange(len(h))
    sizes, bits = pack(levels)
    arrays = {
        "prints": rows["print"].to_numpy(np.int64)[order],
        "counts": rows["n_docs"].to_numpy(np.int64)[order].astype(np.int32),
        "keepers": rows["keeper"].to_numpy(np.int64)[order],
    }
    return pd.DataFrame([{"shard": int(rows["shard"].iloc[0]), "sizes": sizes, "bits": bits} | {k: v.tobytes() for k, v in arrays.items()}])


def probe(probes: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
    """The probes whose line is indexed with a keeper other than their document."""
    if not len(probes) or not len(shard):
        return probes[["doc_id", "text_hash", "line"]].iloc[:0]
    row = shard.iloc[0]
    number = numbers(unpack(row["sizes"], row["bits"]), probes["h"].to_numpy(np.int64).view(np.uint64))
    prints, keepers = np.frombuffer(row["prints"], np.int64), np.frombuffer(row["keepers"], np.int64)
    at = np.maximum(number, 0)
    known = (number >= 0) & (prints[at] == probes["print"].to_numpy(np.int64))
    drop = known & (keepers[at] != probes["doc"].to_numpy(np.int64))
    return probes.loc[drop, ["doc_id", "text_hash", "line"]]


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """``doc_id, text_hash, line, h, print``: a row for each line that is long enough."""
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), line_key)
    hashed = F.transform(
        lines, lambda x, i: F.when(F.char_length(x) >= min_chars, F.struct(i.alias("line"), F.xxhash64(x).alias("h"), F.xxhash64(x, F.lit(1)).alias("print")))
    )
    # The hash of the text is taken below the explode, so that no line carries its whole text along.
    rows = docs.select("doc_id", text_key().alias("text_hash"), "text")
    return rows.select("doc_id", "text_hash", F.explode(F.filter(hashed, lambda x: x.isNotNull())).alias("x")).select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), "text_hash", "x.*"
    )


def line_index(lines: DataFrame, min_docs: int, shards: int) -> DataFrame:
    """One row for each shard of the hashes found in at least ``min_docs`` documents."""
    counted = lines.groupBy("h", "print").agg(F.countDistinct("doc").alias("n_docs"), F.max("doc").alias("keeper")).filter(F.col("n_docs") >= min_docs)
    return counted.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int")).groupBy("shard").applyInPandas(
        index_shard, "shard int, sizes binary, bits binary, prints binary, counts binary, keepers binary"
    )


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, shards: int | None = None) -> DataFrame:
    """``doc_id, text_hash, dropped``: the places of the lines that a document loses."""
    spark = docs.sparkSession
    shards = shards or 4 * parallelism(spark)
    lines = stored(line_hashes(docs, min_chars), "lines").withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    index = stored(line_index(lines, min_docs, shards), "line-index")
    # One row for each shard, so this side is bounded by the number of shards.
    load = lines.groupBy("shard").agg(F.ceil(F.count("*") / PROBES_PER_TASK).cast("int").alias("salts"))
    load = stored(load, "line-loads")
    each = load.select("shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    copies = index.join(F.broadcast(each), "shard").select("shard", "salt", "sizes", "bits", "prints", "counts", "keepers")
    salt = F.pmod(F.xxhash64("doc", "line"), F.col("salts")).cast("int").alias("salt")
    probes = lines.join(F.broadcast(load), "shard").select("shard", salt, "doc_id", "doc", "text_hash", "line", "h", "print")
    kind = docs.schema["doc_id"].dataType.simpleString()
    hits = probes.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt")).applyInPandas(probe, f"doc_id {kind}, text_hash long, line int")
    return hits.groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("dropped"))


def dedup_lines(docs: DataFrame, **limits) -> DataFrame:
    """The packed documents (``doc``) and ``dropped``, the places of the lines each one loses."""
    verdict = dropped_lines(docs, **limits).withColumnsRenamed({"doc_id": "v_id", "text_hash": "v_hash"})
    left = packed(docs)
    return left.join(verdict, left["k_id"].eqNullSafe(verdict["v_id"]) & (left["k_hash"] == verdict["v_hash"]), "left").select("doc", "dropped")


def kept_text() -> Column:
    """The lines that stay, by the line feeds they had."""
    text = F.coalesce("doc.text", F.lit(""))
    return F.when(F.col("dropped").isNull(), text).otherwise(without_lines(text, F.col("dropped")))


def report(docs: DataFrame) -> DataFrame:
    text = F.coalesce("doc.text", F.lit(""))
    n_lines = F.char_length(text) - F.char_length(F.translate(text, "\n", "")) + 1
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc.doc_id", n_lines.cast("long").alias("n_lines"), F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), F.sha2(kept_text(), 256).alias("kept_sha256")
    )


def rewrite(docs: DataFrame) -> DataFrame:
    """The documents without the lines they lose; null text stays null. Extra columns may have any
    names."""
    return unpacked(dedup_lines(docs), docs, F.when(F.col("doc.text").isNotNull(), kept_text()))
