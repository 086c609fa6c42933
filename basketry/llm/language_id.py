"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams of code points (lower-cased) by language over all training rows,
and the rows of each language, which give its prior. Spark adds the counts up. A matrix of
log-probabilities is broadcast and each batch is scored as a sparse product in numpy. A matrix
takes at most ``BLOCK_LANGS`` languages: of more, one block follows the other and each row carries
its best language and the sum of the weights so far.

``score`` is the posterior of the language. The n-grams of a text depend on each other, so a text
of more than ``EVIDENCE`` of them counts as that many of its mean n-gram; shorter ones are plain
multinomial naive Bayes.

Defined cases: null text and texts without a letter are ``und`` with score 0, as is every text
when nothing was learned; rows without doc_id are held out; rows without lang teach nothing;
repeated rows count each time; ties go to the language first in code point order; an empty table
gives an empty result. Only ``doc_id``, ``text`` and, in training, ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.frames import bounded_batches, stored
from basketry.llm.textual import Texts, mixed, slices, texts_of

BUCKETS = 1 << 16
SIZES = (2, 3)
BLOCK_LANGS = 256  # a matrix stays under 64 MB
SMOOTHING = 0.5
EVIDENCE = 40
HELD_OUT = 5
ROWS = -1  # stands for the bucket that counts rows instead of n-grams


class Block(NamedTuple):
    """Some languages in code point order, their log priors and log-probabilities of buckets."""

    langs: list[str]
    prior: np.ndarray
    matrix: np.ndarray


def code_points(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, end to end, and where each text begins."""
    points = np.frombuffer(texts.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    leads = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
    return points, leads[texts.at]


def grams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every n-gram and the text it lies in; n-grams without any letter are left out."""
    points, at = code_points(texts)
    letter = (points >= 0x61) & (points <= 0x7A) | (points >= 0xAA)
    of = np.repeat(np.arange(len(at) - 1), np.diff(at))
    found, owners = [], []
    for size in SIZES:
        if len(points) < size:
            continue
        n = len(points) - size + 1
        code, any_letter = np.full(n, size, np.uint64), np.zeros(n, bool)
        for i in range(size):
            code = code * np.uint64(0x110001) + points[i : i + n]
            any_letter |= letter[i : i + n]
        good = any_letter & (of[:n] == of[size - 1 :])
        found.append((mixed(code[good]) % np.uint64(BUCKETS)).astype(np.int32))
        owners.append(of[:n][good])
    if not found:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(owners)


def held_out(docs: DataFrame):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT == 0, F.lit(True))


def gram_counts(train: DataFrame) -> DataFrame:
    """``lang, bucket, n`` over all training rows (``text`` lower-cased, ``lang``); see ``ROWS``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            lang = batch.column(1).dictionary_encode()
            names, number = lang.dictionary.to_pylist(), lang.indices.to_numpy()
            for i, j, texts in slices(texts_of(batch.column(0))):
                bucket, of = grams(texts)
                kind = number[i:j][of]
                for k in np.unique(number[i:j]):
                    got = np.bincount(bucket[kind == k], minlength=BUCKETS)
                    total[names[k]] = total.get(names[k], 0) + got
                    rows[names[k]] = rows.get(names[k], 0) + int((number[i:j] == k).sum())
        for name, n in total.items():
            some = np.flatnonzero(n)
            bucket, n = np.append(some, ROWS).astype(np.int32), np.append(n[some], rows[name]).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(n), pa.string()), "bucket": pa.array(bucket), "n": pa.array(n)})

    return train.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, block_langs: int = BLOCK_LANGS) -> Iterator[Block]:
    """The languages in blocks; none if nothing was learned. Only one block is held at a time."""
    bounded_batches(docs.sparkSession)
    rows = docs.filter(~held_out(docs) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = stored(gram_counts(rows.select(F.lower("text").cast("binary").alias("text"), F.col("lang").cast("string").alias("lang"))), "language-counts")
    # One narrow row a language.
    n_rows = {r["lang"]: r["n"] for r in counts.filter(F.col("bucket") == ROWS).collect()}
    langs, everything = sorted(n_rows, key=lambda x: x.encode()), sum(n_rows.values())
    for start in range(0, len(langs), block_langs):
        some = langs[start : start + block_langs]
        matrix = np.full((len(some), BUCKETS), SMOOTHING)
        wanted = counts.filter(F.col("bucket") != ROWS).filter(F.col("lang").isin(some))
        # One row of two arrays a language, at most ``BUCKETS`` long.
        packed = wanted.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("g")).select("lang", "g.bucket", "g.n")
        place = {lang: k for k, lang in enumerate(some)}
        for row in packed.toLocalIterator():
            matrix[place[row["lang"]], np.array(row["bucket"])] += np.array(row["n"])
        prior = np.log(np.array([n_rows[x] for x in some]) / everything)
        yield Block(some, prior, np.log(matrix / matrix.sum(axis=1, keepdims=True)).astype(np.float32))


def _advance(rows: DataFrame, block: Block) -> DataFrame:
    """The rows with ``best``, ``top`` (its logit) and ``weight`` after one more block.

    ``weight`` is the sum over all languages so far of their weights, that of ``best`` being 1.
    """
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, prior, matrix = shared.value
        for batch in batches:
            for i, j, texts in slices(texts_of(batch.column("low"))):
                part, rows = batch.slice(i, j - i), np.arange(j - i)
                bucket, of = grams(texts)
                n = np.bincount(of, minlength=j - i)
                sums = np.array([np.bincount(of, weights=row[bucket], minlength=j - i) for row in matrix])
                logit = sums * (np.minimum(n, EVIDENCE) / np.maximum(n, 1)) + prior[:, None]
                first = logit.argmax(axis=0)
                peak = logit[first, rows]
                weight = np.exp(logit - peak).sum(axis=0)
                best, top, old = (part.column(c) for c in ("best", "top", "weight"))
                before = top.to_numpy(zero_copy_only=False)
                # Blocks come in code point order, so an equal logit leaves the earlier language.
                wins = peak > before
                high = np.maximum(peak, before)
                weight = weight * np.exp(peak - high) + old.to_numpy(zero_copy_only=False) * np.exp(before - high)
                names = [langs[first[k]] if wins[k] else best[k].as_py() for k in rows]
                done = {"best": pa.array(names, pa.string()), "top": pa.array(high), "weight": pa.array(weight)}
                yield pa.RecordBatch.from_arrays([done.get(c, part.column(c)) for c in part.schema.names], part.schema.names)

    return rows.mapInArrow(predict, rows.schema)


def score(docs: DataFrame, model: Iterable[Block]) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row."""
    lettered = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    rows = docs.select(
        "doc_id", held_out(docs).alias("held_out"), F.when(lettered, F.lower("text")).cast("binary").alias("low"), lettered.alias("lettered"),
        F.lit(None).cast("string").alias("best"), F.lit(float("-inf")).alias("top"), F.lit(0.0).alias("weight"),
    )
    for number, block in enumerate(model):
        # With the first block scored and stored, its matrix is not needed beside the next one.
        rows = _advance(stored(rows, "language-scores") if number else rows, block)
    known = F.col("lettered") & F.col("best").isNotNull()
    return rows.select(
        "doc_id", "held_out", F.when(known, F.col("best")).otherwise("und").alias("lang_pred"), F.when(known, 1 / F.col("weight")).otherwise(0.0).alias("score")
    )


def report(docs: DataFrame, block_langs: int = BLOCK_LANGS) -> DataFrame:
    return score(docs, train(docs, block_langs))
