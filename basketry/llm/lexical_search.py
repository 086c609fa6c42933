"""Ranked lexical search over a length-stratified index.

The score of a term in a document depends on the document only through its normaliser m (a whole
number that grows with its length) and the term's count tf. Documents of equal m form a stratum.
A stratum is indexed in pieces of bounded size, one row each: the terms, sorted; the postings of a
term grouped by tf, greatest first; the documents in order of their id. So an impact, the factor of
a term's weight, is computed once for each tf of a piece, the first group of a term bounds what it
can add, and the sum of these bounds for a query bounds every document of the piece.

Queries come in blocks of bounded size, one at a time. A block's document frequencies are summed
from the index; then each task visits its pieces in order of their bounds, keeps the best documents
of each query so far, and leaves out the pieces whose bound is under the worst of them. Nothing is
lost by that: a document of a piece left out has a score under those of enough others. The best of
all tasks are ranked together.

Only the numbers of terms of the strata and sums over them are broadcast or reach the driver; a
stratum that holds a third of all documents is as many pieces as its size asks for.

Defined cases: documents without terms (null, empty) are not ranked and count nowhere; each row of
documents is ranked for itself, equal scores by ascending id, rows without id after all others; rows
of one item are one query, terms repeated as often as they stand there; items without id or terms
find nothing; empty tables give an empty result. Terms are compared by 64-bit hashes. Only
``doc_id``, ``text`` and ``item_id`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.frames import bounded_batches, stored
from basketry.llm.textual import ALPHANUMERIC, lists, lowered, slices, spans, texts_of, words

BEST = 20
PIECE_TERMS = 1 << 17  # terms with repeats of the documents of one piece
BLOCK_CHARS = 4 << 20  # text of the queries of one block

# The terms, and the constants of normaliser and impact.
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
SCALE, TF, NORM = 1_000_000_000, 1000, 12
FLOOR, SLOPE = 100 - 25, 25


def impact(tf, m):
    return SCALE * tf // (TF * tf + NORM * m)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, texts in slices(texts_of(batch.column("text"))):
            first = spans(texts, ALPHANUMERIC)[2]
            yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns), pa.array(np.diff(first))], [*batch.schema.names, "n"])


def counted(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n`` of the documents with a term, n terms with repeats."""
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_counted, f"doc_id {kind}, text binary, n long").filter("n > 0")


def sizes(docs: DataFrame) -> DataFrame:
    """``n, docs``: how many documents have n terms."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from (b.select(["n"]) for b in _counted(batches))

    rows = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(measured, "n long")
    return rows.filter("n > 0").groupBy("n").agg(F.count("*").alias("docs"))


def _build(group: pa.Table) -> pa.Table:
    """One piece of a stratum as a row of the index."""
    group = group.sort_by([("doc_id", "ascending")])
    parts, n = [], 0
    for i, j, texts in slices(texts_of(group.column("text"))):
        w = words(lowered(texts), ALPHANUMERIC)
        order = np.lexsort((w.text_of(), w.hash))
        term, slot = w.hash[order], w.text_of()[order]
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (slot[1:] != slot[:-1])
        at = np.flatnonzero(new)
        parts.append((term[at], slot[at] + i, np.diff(np.append(at, len(term)))))
        n = j
    term, slot, tf = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((slot, -tf, term))
    term, slot, tf = term[order], slot[order], tf[order]
    new_term = np.ones(len(term), bool)
    new_term[1:] = term[1:] != term[:-1]
    new_group = new_term.copy()
    new_group[1:] |= tf[1:] != tf[:-1]
    at = np.flatnonzero(new_group)
    first = np.append(np.flatnonzero(new_term[at]), len(at))
    row = {
        "m": group.column("m").combine_chunks().slice(0, 1),
        "ids": lists(group.column("doc_id").combine_chunks(), np.array([n])),
        "terms": [term[new_term].tobytes()],
        "groups": [first.astype(np.uint32).tobytes()],
        "tf": [tf[at].astype(np.uint32).tobytes()],
        "begins": [np.append(at, len(term)).astype(np.uint32).tobytes()],
        "slots": [slot.astype(np.uint32).tobytes()],
    }
    return pa.Table.from_pydict(row)


def strata(docs: DataFrame) -> tuple[DataFrame, int]:
    """``n, m, pieces`` for each number of terms, and the number of documents with a term."""
    found = stored(sizes(docs), "sizes")
    total = found.agg(F.sum("docs").alias("docs"), F.sum(F.col("n") * F.col("docs")).alias("terms")).first()
    n_docs, all_terms = total["docs"] or 0, total["terms"] or 1
    placed = found.withColumn("m", F.expr(f"{FLOOR} + ({SLOPE} * n * {n_docs}L) div {all_terms}L"))
    pieces = placed.groupBy("m").agg(F.ceil(F.sum(F.col("n") * F.col("docs")) / PIECE_TERMS).alias("pieces"))
    return placed.select("n", "m").join(pieces, "m"), n_docs


def build_index(docs: DataFrame) -> tuple[DataFrame, int]:
    """The stored index, a row for each piece, and the number of documents with a term."""
    bounded_batches(docs.sparkSession)
    placed, n_docs = strata(docs)
    rows = counted(docs).join(placed, "n")
    piece = F.pmod(F.xxhash64("doc_id", "text"), F.col("pieces"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    built = rows.select("doc_id", "text", "m", piece.alias("piece")).groupBy("m", "piece").applyInArrow(
        _build, f"m long, ids array<{kind}>, terms binary, groups binary, tf binary, begins binary, slots binary"
    )
    return stored(built, "strata"), n_docs


class Queries:
    """The distinct terms of a block of items, and how often each item holds each."""

    def __init__(self, items: list[tuple]):
        texts: dict = {}
        for item, text in items:
            texts.setdefault(item, []).append(text)
        w = words(lowered(texts_of(pa.array(["\n".join(x) for x in texts.values()], pa.large_string()))), ALPHANUMERIC)
        self.ids = list(texts)
        self.terms = np.unique(w.hash)
        self.of = []
        for k in range(len(texts)):
            term, times = np.unique(w.hash[w.first[k] : w.first[k + 1]], return_counts=True)
            self.of.append((np.searchsorted(self.terms, term), times.astype(np.int64)))
        self.weights = np.zeros(len(self.terms), np.int64)

    def weigh(self, df: dict[int, int], n_docs: int) -> None:
        for k, n in df.items():
            self.weights[k] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))


def _numbers(batch: pa.RecordBatch, column: str, k: int, kind=np.uint32) -> np.ndarray:
    return np.frombuffer(batch.column(column)[k].as_buffer(), kind)


def _known(batch: pa.RecordBatch, k: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the wanted terms a piece holds, and their places among its terms."""
    terms = _numbers(batch, "terms", k, np.uint64)
    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    known = np.flatnonzero(terms[at] == wanted)
    return known, at[known]


def document_frequencies(index: DataFrame, block) -> dict[int, int]:
    """Documents that hold each term of a block that any document holds."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(block.value.terms), np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                known, at = _known(batch, k, block.value.terms)
                groups, begins = (_numbers(batch, c, k).astype(np.int64) for c in ("groups", "begins"))
                total[known] += begins[groups[at + 1]] - begins[groups[at]]
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": found, "df": total[found]})

    counts = index.select("terms", "groups", "begins").mapInArrow(counted, "term long, df long")
    return {r["term"]: r["df"] for r in counts.groupBy("term").agg(F.sum("df").alias("df")).collect()}


class Piece:
    """What the terms of a block meet in one piece, with impacts in place of counts."""

    def __init__(self, batch: pa.RecordBatch, k: int, queries: Queries):
        known, at = _known(batch, k, queries.terms)
        groups, begins = (_numbers(batch, c, k).astype(np.int64) for c in ("groups", "begins"))
        tf = _numbers(batch, "tf", k).astype(np.int64)
        counts, which = np.unique(tf, return_inverse=True)
        impacts = impact(counts, batch.column("m")[k].as_py())[which]
        self.impacts = np.repeat(impacts, np.diff(begins))
        self.slots = _numbers(batch, "slots", k)
        # Range of postings of each term of the block, empty where the piece lacks it.
        self.lo, self.hi, self.most = (np.zeros(len(queries.terms), np.int64) for _ in range(3))
        self.lo[known], self.hi[known], self.most[known] = begins[groups[at]], begins[groups[at + 1]], impacts[groups[at]]
        self.ids = batch.column("ids")[k].values
        self.bounds = [int((queries.weights[t] * n * self.most[t]).sum()) for t, n in queries.of]

    def best(self, terms: np.ndarray, factors: np.ndarray, least: int, k: int) -> list[tuple]:
        """The ``k`` best documents with at least such a score: ``(-score, no id, id)``."""
        score = np.zeros(len(self.ids), np.int64)
        for lo, hi, x in zip(self.lo[terms], self.hi[terms], factors, strict=True):
            score[self.slots[lo:hi]] += x * self.impacts[lo:hi]
        able = np.flatnonzero(score >= max(least, 1))
        if len(able) > k:
            able = able[np.argsort(-score[able], kind="stable")[:k]]  # slots are in order of the ids
        return [(-int(score[s]), (x := self.ids[int(s)].as_py()) is None, x) for s in able]


def candidates(index: DataFrame, block, k: int) -> DataFrame:
    """For each task the best ``k`` documents of its pieces for every query."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = block.value
        best: list[list[tuple]] = [[] for _ in queries.ids]
        for batch in batches:
            pieces = [Piece(batch, r, queries) for r in range(batch.num_rows)]
            for q, (terms, times) in enumerate(queries.of):
                factors = queries.weights[terms] * times
                for piece in sorted(pieces, key=lambda p: -p.bounds[q]):
                    least = -best[q][-1][0] if len(best[q]) == k else 1
                    if piece.bounds[q] < least:
                        break
                    here = (piece.hi > piece.lo)[terms]
                    found = piece.best(terms[here], factors[here], least, k)
                    best[q] = sorted(best[q] + found, key=lambda x: x[:2] + (() if x[1] else x[2:]))[:k]
        rows = [(queries.ids[q], x[2], -x[0]) for q, own in enumerate(best) for x in own]
        items, ids, scores = zip(*rows, strict=True) if rows else ((), (), ())
        schema = block.value.schema
        yield pa.RecordBatch.from_pydict({"item_id": items, "doc_id": ids, "score": scores}, schema)

    kind = index.schema["ids"].dataType.elementType.simpleString()
    return index.mapInArrow(searched, f"item_id {block.value.kind}, doc_id {kind}, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def blocks(items: DataFrame, chars: int) -> Iterator[list[tuple]]:
    """The items in blocks of about so much text; at least one, which may be empty."""
    rows = items.filter("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text")
    total = rows.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    n = -(-total // chars) or 1
    for b in range(n):
        yield [tuple(r) for r in rows.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == b).collect()]


def search(docs: DataFrame, items: DataFrame, k: int = BEST, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every item."""
    spark = docs.sparkSession
    index, n_docs = build_index(docs)
    ids = {"item_id": items.schema["item_id"], "doc_id": docs.schema["doc_id"]}
    empty = spark.createDataFrame([], "item_id {}, doc_id {}, score long".format(*(f.dataType.simpleString() for f in ids.values())))
    schema = empty.toArrow().schema
    found = []
    for block in blocks(items, block_chars):
        queries = Queries(block)
        queries.schema, queries.kind = schema, ids["item_id"].dataType.simpleString()
        terms = spark.sparkContext.broadcast(queries)
        queries.weigh(document_frequencies(index, terms), n_docs)
        terms.unpersist()
        weighed = spark.sparkContext.broadcast(queries)
        found.append(stored(ranked(candidates(index, weighed, k), k), "ranked"))
        weighed.unpersist()
    return reduce(DataFrame.unionByName, found)


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items)
