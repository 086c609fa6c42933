"""Quality rules with cross-document line frequency.

An Arrow function measures each whole text and hashes its normalised lines (words lower-cased,
white space collapsed). Spark counts, for each host (``source``), the distinct documents that hold
a line; exact copies are one document there. Lines held by more than ``share`` of the host's
documents, and by ``min_docs`` at least, are boilerplate; so are those of more than ``max_docs``
documents of the host, however small a share of a very large host that is. A document left with less than
``min_left`` of its words without them is depleted and rejected. Counting is over all documents:
pairs of line and document are made distinct over their own key first, so a line that a third of
the corpus holds meets no single task.

Defined cases: null or empty text has no words and fails the base rules; null source is a host of
its own; repeated rows each get their result and count once; an empty table gives an empty result.
Only ``doc_id``, ``text`` and ``source`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.frames import bounded_batches, packed, stored, text_key, unpacked, without_lines
from basketry.llm.textual import NOT_SPACE, Texts, grouped, hashes, lists, lowered, mixed, ranges, slices, spans, sums_by_text, texts_of, windows, words

SHARE = 0.1
MIN_DOCS = 10
MAX_DOCS = 10_000
MIN_LEFT = 0.5
MIN_WORDS = 50

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_NOT_FEED = np.arange(256) != 10


def repeated_words(w, k: int = 3) -> np.ndarray:
    """Words of each text in windows of ``k`` words that the text holds twice or more."""
    lo, h = windows(w, k)
    order, first = grouped(mixed(h + w.text_of()[lo].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    often = np.repeat(np.diff(np.append(first, len(order))) > 1, np.diff(np.append(first, len(order))))
    covered = np.zeros(len(w.hash) + k, bool)
    for i in range(k):
        covered[lo[order[often]] + i] = True
    return sums_by_text(covered, w.first)


def measure(texts: Texts) -> dict[str, np.ndarray]:
    """The base measures of each text, and its lines with a word: counts, hashes, words."""
    w = words(texts)
    data, at = texts
    leads = ((data & 0xC0) != 0x80) & NOT_SPACE[data]
    # Lines with a word, as ranges of words: a line begins where the line number changes.
    start, end, first = spans(texts, _NOT_FEED)
    lo, hi = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
    full = hi > lo
    of = np.repeat(np.arange(len(at) - 1), np.diff(first))[full]
    raw = hashes(data, start[full], end[full])
    order, runs = grouped(mixed(raw + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    n_lines = np.bincount(of, minlength=len(at) - 1)
    low = words(lowered(texts))
    # Places of the lines among all lines of the text, line feeds counted.
    feeds = np.concatenate([[0], np.cumsum(data == 10)])
    return {
        "n_words": w.counts,
        "word_chars": sums_by_text(leads, at),
        "n_symbols": sums_by_text(_SYMBOL[data], at),
        "n_dup_lines": n_lines - np.bincount(of[order[runs]], minlength=len(at) - 1),
        "n_repeat_words": repeated_words(w),
        "line_count": n_lines,
        "line_hash": ranges(low.hash, lo[full], hi[full]).view(np.int64),
        "line_words": (hi - lo)[full],
        "line_place": (feeds[start] - feeds[at[:-1]][np.repeat(np.arange(len(at) - 1), np.diff(first))])[full],
    }


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, texts in slices(texts_of(batch.column(3))):
            m = measure(texts)
            line = pa.StructArray.from_arrays([pa.array(m[k]) for k in ("line_place", "line_hash", "line_words")], ["place", "hash", "words"])
            columns = [batch.column(k).slice(i, j - i) for k in range(3)] + [pa.array(m[k]) for k in MEASURES] + [lists(line, m["line_count"])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "source", "text_hash", *MEASURES, "lines"])


def measured(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", "source")]
    rows = docs.select("doc_id", "source", text_key().alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(
        _measured, ", ".join([*kinds, "text_hash long", *(f"{m} long" for m in MEASURES), "lines array<struct<place:long,hash:long,words:long>>"])
    )


def verdicts(
    docs: DataFrame, share: float = SHARE, min_docs: int = MIN_DOCS, min_left: float = MIN_LEFT, min_words: int = MIN_WORDS, max_docs: int = MAX_DOCS
) -> DataFrame:
    """The measures with ``base_failed``, ``n_cut_words``, ``cut`` (places of lines), ``kept``."""
    rows = stored(measured(docs), "line-measures")
    lines = rows.select("doc_id", "source", "text_hash", F.explode("lines").alias("line")).select("doc_id", "source", "text_hash", "line.*")
    held = lines.groupBy("source", "hash", "text_hash").agg(F.lit(1).alias("one")).groupBy("source", "hash").agg(F.count("*").alias("n"))
    hosts = rows.groupBy("source", "text_hash").agg(F.lit(1).alias("one")).groupBy("source").agg(F.count("*").alias("n_docs"))
    often = held.filter(F.col("n") >= min_docs).alias("a").join(hosts.alias("b"), F.expr("a.source <=> b.source")).filter((F.col("n") > share * F.col("n_docs")) | (F.col("n") > max_docs))
    often = often.select(F.col("a.source").alias("o_source"), F.col("hash").alias("o_hash"))
    cut = lines.join(often, F.expr("source <=> o_source AND hash = o_hash")).groupBy("doc_id", "source", "text_hash").agg(F.collect_set(F.struct("place", "words")).alias("gone"))
    cut = cut.withColumnsRenamed({c: f"c_{c}" for c in ("doc_id", "source", "text_hash")})
    found = rows.join(cut, F.expr("doc_id <=> c_doc_id AND source <=> c_source AND text_hash = c_text_hash"), "left")
    n_cut = F.coalesce(F.aggregate("gone", F.lit(0).cast("long"), lambda a, x: a + x["words"]), F.lit(0).cast("long"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = F.col("n_words") - F.col("n_cut_words") < min_left * F.col("n_words")
    return found.withColumn("n_cut_words", n_cut).withColumn("base_failed", failed).select(
        "doc_id", "source", "text_hash", *MEASURES, "base_failed", "n_cut_words", F.col("gone.place").alias("cut"), (~F.col("base_failed") & ~depleted).alias("kept")
    )


def report(docs: DataFrame, **limits) -> DataFrame:
    return verdicts(docs, **limits).select("doc_id", *MEASURES, "base_failed", "kept", "n_cut_words")


def clean(docs: DataFrame, **limits) -> DataFrame:
    """The kept documents without their frequent lines, with all their columns, whatever their names."""
    good = verdicts(docs, **limits).filter("kept").select(
        F.col("doc_id").alias("g_id"), F.col("source").alias("g_source"), F.col("text_hash").alias("g_hash"), "cut"
    ).dropDuplicates(["g_id", "g_source", "g_hash"])
    left = packed(docs)
    joined = left.join(good, left["k_id"].eqNullSafe(good["g_id"]) & left["doc.source"].eqNullSafe(good["g_source"]) & (left["k_hash"] == good["g_hash"]))
    text = F.col("doc.text")
    return unpacked(joined, docs, F.when(F.col("cut").isNull(), text).otherwise(without_lines(text, F.col("cut"))))
