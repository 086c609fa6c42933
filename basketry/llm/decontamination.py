"""Benchmark decontamination with a distributed positional inverted index.

Documents are indexed in segments of a few MB, one row each: the terms, sorted; for each term the
ascending list of its places in the segment; and where each document begins. Segments are written
once, so the index can answer other test sets too. Test windows come in blocks of bounded size; a
block is broadcast and every segment answers it alone: a window is dropped unless all its terms
are there, its candidates are the postings of its rarest term moved by the term's offset, and each
further term, the next rarest first, keeps the candidates found in its moved postings. With
``slop`` a posting up to so many words off its place counts, which gives proximity matches.

Hits leave a segment as merged ranges of words for each document, so a passage that many documents
share costs each of them one range.

Defined cases: null or empty text has no words; items without words or without id find nothing;
rows of one item_id are one item; each row of documents is judged for itself, also where ids
repeat or are null; without items nothing is hit; an empty table gives an empty result. Only
``doc_id``, ``text`` and ``item_id`` are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.frames import bounded_batches, stored, text_key
from basketry.llm.textual import ALPHANUMERIC, grouped, lists, lowered, slices, texts_of, words

WINDOW = 13
BLOCK_WORDS = 500_000  # words of test items in one broadcast block, about 30 MB as windows
SEGMENT = 2 << 20


def index_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), itertools.count()
    for batch in batches:
        keys = batch.column(0)
        for i, j, texts in slices(texts_of(batch.column(1)), SEGMENT):
            w = words(lowered(texts), ALPHANUMERIC)
            order, first = grouped(w.hash)
            yield pa.RecordBatch.from_pydict(
                {
                    "segment": pa.array([part << 32 | next(number)], pa.int64()),
                    "keys": lists(keys.slice(i, j - i), np.array([j - i])),
                    "begins": [w.first.astype(np.uint32).tobytes()],
                    "terms": [w.hash[order[first]].tobytes()],
                    "first": [np.append(first, len(order)).astype(np.uint32).tobytes()],
                    "places": [order.astype(np.uint32).tobytes()],
                }
            )


def build_index(docs: DataFrame) -> DataFrame:
    """The stored index: a row for each segment."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    key = F.struct("doc_id", text_key().alias("text_hash"))
    rows = docs.select(key.alias("key"), F.col("text").cast("binary").alias("text")).mapInArrow(
        index_segments, f"segment long, keys array<struct<doc_id:{kind},text_hash:long>>, begins binary, terms binary, first binary, places binary"
    )
    return stored(rows, "postings")


class Windows:
    """Distinct windows of a block of items, and the items they come from."""

    def __init__(self, items: list[tuple], window: int):
        self.ids = sorted({str(i) for i, _ in items})
        number = {x: k for k, x in enumerate(self.ids)}
        of: dict[bytes, set[int]] = {}
        w = words(lowered(texts_of(pa.array([t for _, t in items], pa.string()))), ALPHANUMERIC)
        for k, (item, _) in enumerate(items):
            h = w.hash[w.first[k] : w.first[k + 1]]
            size = min(window, len(h))
            for p in range(len(h) - size + 1 if size else 0):
                of.setdefault(h[p : p + size].tobytes(), set()).add(number[str(item)])
        self.size = np.array([len(x) // 8 for x in of], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.size)])
        self.terms = np.frombuffer(b"".join(of), np.uint64)
        self.items = [np.array(sorted(x), np.int64) for x in of.values()]


def search(segment: dict, found: Windows, slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows that occur in a segment, the place and the document of each occurrence.

    With ``slop`` the place is where the window would start by its rarest term.
    """
    none = (np.empty(0, np.int64),) * 3
    terms, first = np.frombuffer(segment["terms"], np.uint64), np.frombuffer(segment["first"], np.uint32).astype(np.int64)
    places, begins = np.frombuffer(segment["places"], np.uint32).astype(np.int64), np.frombuffer(segment["begins"], np.uint32).astype(np.int64)
    if not len(terms) or not len(found.size):
        return none
    at = np.minimum(np.searchsorted(terms, found.terms), len(terms) - 1)
    known = terms[at] == found.terms
    whole = np.logical_and.reduceat(known, found.begin[:-1])
    n = np.where(known, first[at + 1] - first[at], 0)
    window = np.flatnonzero(whole)
    if not len(window):
        return none
    # Terms of each remaining window, the rarest first: a matrix padded with -1.
    widest = int(found.size[window].max())
    offset = np.arange(widest)[None, :].repeat(len(window), 0)
    inside = offset < found.size[window][:, None]
    term = np.where(inside, found.begin[window][:, None] + offset, 0)
    rank = np.argsort(np.where(inside, n[term], np.iinfo(np.int64).max), axis=1, kind="stable")
    term, offset, inside = (np.take_along_axis(x, rank, 1) for x in (term, offset, inside))
    # Candidates: postings of the rarest term, moved by its offset.
    rare, count = at[term[:, 0]], n[term[:, 0]]
    row = np.repeat(np.arange(len(window)), count)
    start = places[np.repeat(first[rare], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)] - offset[row, 0]
    text = np.searchsorted(begins, start + offset[row, 0], "right") - 1
    if slop:
        fits = np.ones(len(start), bool)
    else:
        fits = (start >= begins[text]) & (start + found.size[window[row]] <= begins[text + 1])
    row, start, text = row[fits], start[fits], text[fits]
    # One ascending array of (term, place), so all lists are searched at once.
    postings = (np.repeat(np.arange(len(terms)), np.diff(first)) << 32) | places
    for k in range(1, widest):
        due = inside[row, k]
        wanted = (at[term[row, k]] << 32) + start + offset[row, k]
        low = np.maximum(wanted - slop, (at[term[row, k]] << 32) + begins[text])
        hit = np.minimum(np.searchsorted(postings, low), len(postings) - 1)
        high = np.minimum(wanted + slop, (at[term[row, k]] << 32) + begins[text + 1] - 1)
        ok = ~due | ((postings[hit] >= low) & (postings[hit] <= high))
        row, start, text = row[ok], start[ok], text[ok]
    return window[row], start, text


def matches(index: DataFrame, block, all_rows: bool, slop: int) -> DataFrame:
    """A row for each document with a hit in this block, for every document if ``all_rows``."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Windows = block.value
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in ("begins", "terms", "first", "places")}
                row = {c: v.as_buffer() for c, v in row.items()}
                window, start, text = search(row, found, slop)
                begins = np.frombuffer(row["begins"], np.uint32).astype(np.int64)
                n_docs = len(begins) - 1
                # Words covered by any occurrence, as merged ranges.
                change = np.zeros(begins[-1] + 1, np.int64)
                np.add.at(change, np.maximum(start, begins[text]), 1)
                np.add.at(change, np.minimum(start + found.size[window], begins[text + 1]), -1)
                covered = np.cumsum(change)[:-1] > 0
                edge = np.zeros(len(covered) + 1, bool)
                edge[begins] = True
                lo = np.flatnonzero(covered & (~np.concatenate([[False], covered[:-1]]) | edge[:-1]))
                hi = np.flatnonzero(covered & (~np.concatenate([covered[1:], [False]]) | edge[1:])) + 1
                of = np.searchsorted(begins, lo, "right") - 1
                n_ranges = np.bincount(of, minlength=n_docs)
                # Items with an occurrence, by document.
                kinds = np.array([len(x) for x in found.items], np.int64)[window] if len(window) else np.empty(0, np.int64)
                item = np.concatenate([found.items[x] for x in window]) if len(window) else np.empty(0, np.int64)
                doc = np.repeat(text, kinds)
                pairs = np.unique(doc * (len(found.ids) + 1) + item)
                doc, item = pairs // (len(found.ids) + 1), pairs % (len(found.ids) + 1)
                n_items = np.bincount(doc, minlength=n_docs)
                yielded = np.arange(n_docs) if all_rows else np.flatnonzero(n_ranges)
                full = pa.RecordBatch.from_pydict(
                    {
                        "segment": pa.array(np.full(n_docs, batch.column("segment")[k].as_py())),
                        "number": pa.array(np.arange(n_docs, dtype=np.int32)),
                        "key": batch.column("keys")[k].values,
                        "n_words": pa.array(np.diff(begins)),
                        "ranges": lists(pa.StructArray.from_arrays([pa.array(lo - begins[of]), pa.array(hi - begins[of])], ["lo", "hi"]), n_ranges),
                        "items": lists(pa.array([found.ids[x] for x in item], pa.string()), n_items),
                    }
                )
                yield full.take(pa.array(yielded))

    kind = index.schema["keys"].dataType.elementType.simpleString()
    return index.mapInArrow(answer, f"segment long, number int, key {kind}, n_words long, ranges array<struct<lo:long,hi:long>>, items array<string>")


def item_blocks(items: DataFrame, window: int, block_words: int) -> Iterator[Windows]:
    """The test items in blocks of bounded size; at least one block, which may be empty."""
    rows = items.filter("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text")
    total = rows.agg(F.coalesce(F.sum(F.regexp_count("text", F.lit("[^ ]+"))), F.lit(0))).first()[0]
    n = -(-total // block_words) or 1
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n)))
    for k in range(n):
        yield Windows([tuple(r) for r in rows.filter(F.col("block") == k).select("item_id", "text").collect()], window)


def find_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, n_words, ranges, items`` for each row of the documents.

    ``ranges`` are the hit words, half open and apart; ``items`` the ids with an occurrence.
    """
    index, found = build_index(docs), None
    for block in item_blocks(items, window, block_words):
        part = matches(index, docs.sparkSession.sparkContext.broadcast(block), found is None, slop)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("segment", "number").agg(
        F.first("key").alias("key"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("ranges")).alias("ranges"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    ).select("key.doc_id", "key.text_hash", "n_words", "ranges", "items")


def n_hit():
    """Words in the union of the ranges."""
    step = lambda a, r: F.struct(F.greatest(a["to"], r["hi"]).alias("to"), (a["n"] + F.greatest(r["hi"] - F.greatest(r["lo"], a["to"]), F.lit(0))).alias("n"))
    zero = F.struct(F.lit(0).cast("long").alias("to"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(F.array_sort("ranges"), zero, step)["n"]


def judged(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The matches with ``n_hit`` and ``contaminated``: a twentieth of the words or more is hit."""
    found = find_matches(docs, items, **options).withColumn("n_hit", n_hit())
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    return judged(docs, items, **options).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = judged(docs, items, **options).filter("contaminated").select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (text_key() == bad["bad_hash"]), "left_anti")
