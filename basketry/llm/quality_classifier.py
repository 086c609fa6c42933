"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL.

Features are hashes of single words and word pairs, and the same over word shapes (letters, upper
case, digits, signs), with a mark where a word repeats the one before. A text is its feature
frequencies, scaled to length one. Labelled rows are dealt to shards of bounded size by a hash; in
each round every shard runs follow-the-regularised-leader from the common weights and the results
are averaged by Spark, weighted by rows. At most ``TRAIN_ROWS`` labelled documents take part, those
with the least hashes of their id; fewer are all used. The weights have a fixed size and are broadcast; scoring is a sparse dot product for each text.

Defined cases: null and empty text has no features and scores the bias; rows without doc_id are
held out; null labels teach nothing; several labels of a document count as the greater one;
without training rows every score is 0.5; repeated rows each get their result; an empty table gives
an empty result. Read are ``doc_id`` and ``text``, and ``doc_id, quality`` of the labels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.frames import bounded_batches, stored, text_key
from basketry.llm.textual import LOWER, Texts, mixed, slices, texts_of, words

BUCKETS = 1 << 18
TRAIN_ROWS = 20_000
SHARD_ROWS = 2_000
ROUNDS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 1.0
FOLDS, HELD = 3, 1

_UPPER = np.isin(np.arange(256), range(0x41, 0x5B))
_DIGIT = np.isin(np.arange(256), range(0x30, 0x3A))
_LETTER = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and values of each text's distinct features, and where each text begins."""
    w = words(Texts(LOWER[texts.data], texts.at))
    of, n = w.text_of(), len(w.hash)
    bounds = np.stack([w.start, w.end])

    def inside(kind: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(kind[texts.data])])
        return total[bounds[1]] - total[bounds[0]]

    size, upper, letters, digits = w.end - w.start, inside(_UPPER), inside(_LETTER), inside(_DIGIT)
    signs = size - letters - digits
    repeats = np.concatenate([[False], (w.hash[1:] == w.hash[:-1]) & (of[1:] == of[:-1])]) if n else np.zeros(0, bool)
    shape = (np.minimum(signs, 3) | np.minimum(upper, 2) << 2 | (upper == letters).astype(np.int64) << 4 | (letters > 0).astype(np.int64) << 5 | np.minimum(digits, 3) << 6 | repeats.astype(np.int64) << 8).astype(np.uint64)
    pair = np.flatnonzero(of[1:] == of[:-1]) if n else np.empty(0, np.int64)
    third = np.uint64(0x9E3779B97F4A7C15)
    hashed = [w.hash, mixed(w.hash[pair] * third + w.hash[pair + 1]), mixed(shape + np.uint64(1 << 20)), mixed((shape[pair] << np.uint64(10)) + shape[pair + 1] + np.uint64(1 << 40))]
    owner = np.concatenate([of, of[pair], of, of[pair]])
    key = owner * BUCKETS + (np.concatenate(hashed) % np.uint64(BUCKETS)).astype(np.int64)
    key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    count = np.diff(np.append(first, len(key))).astype(np.float64)
    key = key[first]
    at = np.searchsorted(key, np.arange(len(texts.at)) * BUCKETS)
    norm = np.sqrt(np.diff(np.concatenate([[0.0], np.cumsum(count**2)])[at]))
    return key % BUCKETS, count / np.repeat(norm, np.diff(at)), at


def follow_leader(texts: Texts, label: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weights after one pass of FTRL-proximal over the rows; the last weight is the bias."""
    squares = np.full(BUCKETS + 1, 1e-12)
    # Start where the closed form gives the common weights back.
    sums = -weights * ((BETA + np.sqrt(squares)) / ALPHA + L2) - L1 * np.sign(weights)
    for first, _, some in slices(texts):
        bucket, value, at = features(some)
        for k in range(len(at) - 1):
            i = np.append(bucket[at[k] : at[k + 1]], BUCKETS)
            x = np.append(value[at[k] : at[k + 1]], 1.0)
            z, q = sums[i], squares[i]
            step = (BETA + np.sqrt(q)) / ALPHA
            w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / (step + L2))
            g = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35))) - label[first + k]) * x
            sums[i] = z + g - ((BETA + np.sqrt(q + g * g)) / ALPHA - step) * w
            squares[i] = q + g * g
    return np.where(np.abs(sums) <= L1, 0.0, -(sums - np.sign(sums) * L1) / ((BETA + np.sqrt(squares)) / ALPHA + L2))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``shard, text_hash, text, label``: shards of about ``SHARD_ROWS`` rows by a hash.

    A row that repeats in full teaches once.
    """
    known = labels.select("doc_id", "quality").filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(~held_out())
    marks = known.groupBy("doc_id").agg(F.max("quality").alias("label"))
    marks = stored(marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS), "labels")
    shards = max(1, -(-marks.count() // SHARD_ROWS))
    rows = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").withColumn("once", text_key()).dropDuplicates(["doc_id", "once"])
    return rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard"), text_key().alias("text_hash"), F.col("text").cast("binary").alias("text"), F.col("label").cast("int").alias("label"))


def learner(common) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """What a shard does: a pass from the common weights, its share of the average."""

    def learn(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["text_hash", "label"], kind="stable")
        w = follow_leader(texts_of(pa.array(shard["text"], pa.binary())), shard["label"].to_numpy(np.float64), common.value)
        some = np.flatnonzero(w)
        return pd.DataFrame({"bucket": some.astype(np.int32), "part": w[some] * len(shard)})

    return learn


def train(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = stored(training_rows(docs, labels), "training")
    total, weights = rows.count(), np.zeros(BUCKETS + 1)
    for _ in range(rounds):
        learned = rows.groupBy("shard").applyInPandas(learner(spark.sparkContext.broadcast(weights)), "bucket int, part double")
        parts = learned.groupBy("bucket").agg(F.sum("part").alias("part"))
        found = parts.toPandas()  # at most BUCKETS + 1 rows
        weights = np.zeros(BUCKETS + 1)
        weights[found["bucket"].to_numpy()] = found["part"].to_numpy() / max(total, 1)
    return weights


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for i, j, texts in slices(texts_of(batch.column(1))):
                bucket, value, at = features(texts)
                total = np.bincount(np.repeat(np.arange(j - i), np.diff(at)), weights=w[bucket] * value, minlength=j - i) + w[-1]
                p = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(p)], ["doc_id", "held_out", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), held_out().alias("held_out"))
    return rows.mapInArrow(predict, f"doc_id {kind}, held_out boolean, score double")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
