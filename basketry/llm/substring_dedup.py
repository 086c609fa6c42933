"""Substring dedup by recompression.

Texts are parsed by rounds: maximal runs of one symbol get a name, then neighbouring pairs of a
left and a right symbol (one bit of each symbol says which it is) get a name. A name is a hash of
what it stands for, so all tasks name alike without talking to each other, and equal word
sequences get equal symbols but for the few near their ends. For each symbol the words that
decided it are tracked; wherever those words occur, the symbol occurs.

1. Documents are dealt by a hash to chunks of a few MB, stored bucketed by chunk, so later steps
   read a chunk's documents without another shuffle.
2. Each chunk sends its distinct symbols of the last round, with the least and greatest document,
   to the owner of the symbol, which answers with those found in two documents or more.
3. A window of 50 words over a symbol of one document only cannot repeat elsewhere. The other
   windows are verified: their hashes (64 bits and 32 more) go to owners in the same way, which
   answer with those that start in an earlier document of another chunk.
4. Each chunk removes the words of the windows so answered or repeated within the chunk.

A sequence held by a third of the documents is one entry of each chunk. Only hashes travel after
step 1. The number of rounds changes how much is verified, never the result.

Defined cases: null and empty text has no words; texts under 50 words stay whole; documents
without doc_id stay whole and are no earlier document; rows that share a doc_id never count
against each other; repeated rows each get their result; an empty table gives an empty result.
Only ``doc_id`` (whole numbers) and ``text`` are read.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.frames import parallelism
from basketry.llm.textual import Texts, Words, mixed, texts_of, windows, words
from basketry.session import scratch_dir

WINDOW = 50
ROUNDS = 6
CHUNK_CHARS = 4 << 20
CHUNKS_PER_PART = 4  # chunks' worth of symbols in one owner


class Symbols(NamedTuple):
    name: np.ndarray
    start: np.ndarray  # words it stands for, half open
    end: np.ndarray
    low: np.ndarray  # words that decided it, half open; beyond the text if a border did
    high: np.ndarray
    text: np.ndarray


def _joined(s: Symbols, first: np.ndarray, last: np.ndarray, name: np.ndarray) -> Symbols:
    return Symbols(name, s.start[first], s.end[last], s.low[first], s.high[last], s.text[first])


def name_runs(s: Symbols, word: np.ndarray) -> Symbols:
    """Maximal runs of equal symbols become one.

    A run ends where the neighbour differs. It differs for sure if the word next to the run is not
    the one that would continue it, so that one word decides; else the whole neighbour does.
    """
    same = (s.name[1:] == s.name[:-1]) & (s.text[1:] == s.text[:-1])
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    last = np.append(first[1:], len(s.name)) - 1
    size = (last - first + 1).astype(np.uint64)
    name = np.where(size > 1, mixed(s.name[first] * np.uint64(0x9E3779B97F4A7C15) + size), s.name[first])
    r = _joined(s, first, last, name)
    low, high = r.low.copy(), r.high.copy()
    left = np.flatnonzero(r.text[1:] == r.text[:-1]) + 1  # symbols with a left neighbour
    plain = word[r.start[left] - 1] != word[r.end[left] - 1]
    low[left] = np.minimum(low[left], np.where(plain, r.start[left] - 1, r.low[left - 1]))
    right = left - 1
    plain = word[r.end[right]] != word[r.start[right]]
    high[right] = np.maximum(high[right], np.where(plain, r.end[right] + 1, r.high[right + 1]))
    # At the border of a text nothing shows how the sequence goes on elsewhere.
    edge = np.ones(len(low), bool)
    edge[left] = False
    low[edge] = r.start[edge] - 1
    edge = np.ones(len(low), bool)
    edge[right] = False
    high[edge] = r.end[edge] + 1
    return r._replace(low=low, high=high)


def name_pairs(s: Symbols, number: int) -> Symbols:
    """Each left symbol and the right symbol after it become one."""
    right = (mixed(s.name + np.uint64(number * 2 + 1)) >> np.uint64(63)).astype(bool)
    beside = s.text[1:] == s.text[:-1]
    joins = np.append(~right[:-1] & right[1:] & beside, False)  # with the next symbol
    joined = np.concatenate([[False], joins[:-1]])
    first = np.flatnonzero(~joined)
    last = first + joins[first]
    name = np.where(joins[first], mixed(s.name[first] * np.uint64(0xC2B2AE3D27D4EB4F) + s.name[last] + np.uint64(number)), s.name[first])
    r = _joined(s, first, last, name)
    # An unpaired symbol depends on the neighbour that could have paired with it.
    alone = ~joins[first]
    needs_left = np.flatnonzero(alone & right[first])
    needs_right = np.flatnonzero(alone & ~right[first])
    low, high = r.low.copy(), r.high.copy()
    at = first[needs_left]
    has = (at > 0) & (s.text[at] == s.text[np.maximum(at - 1, 0)])
    low[needs_left] = np.where(has, np.minimum(low[needs_left], s.low[np.maximum(at - 1, 0)]), r.start[needs_left] - 1)
    high[needs_left] = np.where(has, np.maximum(high[needs_left], s.high[np.maximum(at - 1, 0)]), high[needs_left])
    at = first[needs_right]
    after = np.minimum(at + 1, len(s.name) - 1)
    has = (at + 1 < len(s.name)) & (s.text[at] == s.text[after])
    high[needs_right] = np.where(has, np.maximum(high[needs_right], s.high[after]), r.end[needs_right] + 1)
    low[needs_right] = np.where(has, np.minimum(low[needs_right], s.low[after]), low[needs_right])
    return r._replace(low=low, high=high)


def parse(w: Words, rounds: int) -> Symbols:
    """The symbols after some rounds."""
    place = np.arange(len(w.hash))
    s = Symbols(w.hash, place, place + 1, place, place + 1, w.text_of())
    for number in range(rounds if len(place) else 0):
        s = name_pairs(name_runs(s, w.hash), number)
    # What a border of the text decided says nothing about the sequence elsewhere.
    low = np.where(s.low < w.first[s.text], -(1 << 40), s.low)
    high = np.where(s.high > w.first[s.text + 1], 1 << 40, s.high)
    return s._replace(low=low, high=high)


def chunk_words(chunk: pd.DataFrame) -> tuple[pd.DataFrame, Texts, Words]:
    """The documents of a chunk by id, those without one last."""
    rows = chunk.sort_values("doc_id", kind="stable", na_position="last")
    texts = texts_of(pa.array(rows["text"], pa.binary()))
    return rows, texts, words(texts)


def ids(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The ids as whole numbers, and which rows have one."""
    known = rows["doc_id"].notna().to_numpy()
    return pd.array(rows["doc_id"], "Int64").fillna(0).to_numpy(np.int64), known


def messages(chunk: int, parts: int, keys: np.ndarray, doc: np.ndarray, check: np.ndarray | None = None) -> pd.DataFrame:
    """The distinct keys of a chunk with their least and greatest document, by owner."""
    order = np.lexsort((doc, keys)) if check is None else np.lexsort((doc, check, keys))
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    if check is not None:
        check = check[order]
        new[1:] |= check[1:] != check[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(keys)) - 1
    columns = {"keys": keys[first], "least": doc[first], "most": doc[last[: len(first)]]}
    columns["checks"] = np.zeros(len(first), np.uint32) if check is None else check[first]
    part = ((columns["keys"] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    cut = np.flatnonzero(np.diff(part)) + 1
    pieces = {k: np.split(v, cut) for k, v in columns.items()} if len(part) else {k: [] for k in columns}
    owners = part[np.concatenate([[0], cut])] if len(part) else []
    return pd.DataFrame(
        {"part": np.array(owners, np.int64), "chunk": np.full(len(owners), chunk, np.int64)}
        | {k: [x.tobytes() for x in pieces[k]] for k in ("keys", "checks", "least", "most")}
    )


MESSAGE = "part long, chunk long, keys binary, checks binary, least binary, most binary"
ANSWER = "chunk long, keys binary"


def answers(rows: pd.DataFrame, earlier: bool) -> pd.DataFrame:
    """For each chunk the keys it shares: found in two documents, or in one before all of its own."""
    size = np.array([len(x) // 8 for x in rows["keys"]])
    keys, least, most, check = (np.concatenate([np.frombuffer(x, t) for x in rows[c]]) for c, t in (("keys", np.uint64), ("least", np.int64), ("most", np.int64), ("checks", np.uint32)))
    of = np.repeat(np.arange(len(rows)), size)
    order = np.lexsort((check, keys))
    new = np.ones(len(order), bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]) | (check[order][1:] != check[order][:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(order)))
    low = np.repeat(np.minimum.reduceat(least[order], first), times)
    told = low < least[order] if earlier else low < np.repeat(np.maximum.reduceat(most[order], first), times)
    keys, of = keys[order][told], of[order][told]
    by_row = np.argsort(of, kind="stable")
    pieces = np.split(keys[by_row], np.cumsum(np.bincount(of, minlength=len(rows)))[:-1])
    out = pd.DataFrame({"chunk": rows["chunk"].to_numpy(np.int64), "keys": [x.tobytes() for x in pieces]})
    return out[[len(x) > 0 for x in pieces]]


def known_keys(rows: pd.DataFrame) -> np.ndarray:
    return np.unique(np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(x, np.uint64) for x in rows["keys"])]))


def member(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known) or not len(keys):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def send_symbols(chunk: pd.DataFrame, parts: int, window: int, rounds: int) -> pd.DataFrame:
    rows, _, w = chunk_words(chunk)
    doc, has_id = ids(rows)
    s = parse(w, rounds)
    useful = (s.high - s.low <= window) & has_id[s.text] if len(s.name) else np.zeros(0, bool)
    return messages(int(chunk["chunk"].iloc[0]), parts, s.name[useful], doc[s.text[useful]])


def send_windows(chunk: pd.DataFrame, shared: pd.DataFrame, parts: int, window: int, rounds: int) -> pd.DataFrame:
    """The windows that no symbol of a single document rules out."""
    if not len(chunk):
        return messages(0, parts, np.empty(0, np.uint64), np.empty(0, np.int64))
    rows, _, w = chunk_words(chunk)
    doc, has_id = ids(rows)
    s = parse(w, rounds)
    useful = s.high - s.low <= window
    single = np.flatnonzero(useful & ~member(s.name, known_keys(shared)))
    change = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(change, np.maximum(s.high[single] - window, 0), 1)
    np.add.at(change, s.low[single] + 1, -1)
    start, h = windows(w, window)
    of = w.text_of()[start]
    due = (np.cumsum(change)[start] == 0) & has_id[of]
    _, check = windows(w, window, "check")
    return messages(int(chunk["chunk"].iloc[0]), parts, h[due], doc[of[due]], (check[due] >> np.uint64(32)).astype(np.uint32))


def remove(chunk: pd.DataFrame, earlier: pd.DataFrame, window: int) -> pd.DataFrame:
    """The result of each document of a chunk: words, words removed, the text that is left."""
    if not len(chunk):
        return pd.DataFrame({"doc_id": pd.array([], "Int64"), "text_hash": [], "n_words": [], "n_removed": [], "kept": []})
    rows, texts, w = chunk_words(chunk)
    doc, has_id = ids(rows)
    start, h = windows(w, window)
    of = w.text_of()[start]
    gone = member(h, known_keys(earlier))
    # Within the chunk: documents come by id, so the first of equal windows is the earliest.
    own = np.flatnonzero(has_id[of])
    order = own[np.argsort(h[own], kind="stable")]
    new = np.ones(len(order), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    gone[order] |= doc[of[order]] > doc[of[first]]
    change = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(change, start[gone & has_id[of]], 1)
    np.add.at(change, start[gone & has_id[of]] + window, -1)
    stays = np.cumsum(change)[:-1] == 0
    raw, kept = texts.data.tobytes(), []
    for k in range(len(rows)):
        lo, hi = w.first[k], w.first[k + 1]
        if stays[lo:hi].all():
            kept.append(b" ".join(raw[texts.at[k] : texts.at[k + 1]].split()))
        else:
            left = np.flatnonzero(stays[lo:hi]) + lo
            kept.append(b" ".join([raw[a:b] for a, b in zip(w.start[left].tolist(), w.end[left].tolist())]))
    return pd.DataFrame(
        {
            "doc_id": pd.array(rows["doc_id"], "Int64"), "text_hash": rows["text_hash"].to_numpy(), "n_words": w.counts,
            "n_removed": [int((~stays[w.first[k] : w.first[k + 1]]).sum()) for k in range(len(rows))], "kept": kept,
        }
    )


def chunked(docs: DataFrame, chars: int) -> tuple[DataFrame, int]:
    """The documents with a chunk number, stored bucketed by it, and the number of chunks."""
    spark = docs.sparkSession
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // chars))
    buckets = max(1, min(n, parallelism(spark)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(n)).cast("long"))
    name = f"chunks_{uuid.uuid4().hex}"
    writer = rows.repartition(buckets, "chunk").write.bucketBy(buckets, "chunk").option("path", scratch_dir(spark, "chunks"))
    writer.saveAsTable(name)
    return spark.table(name), n


def without_repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, chars: int = CHUNK_CHARS) -> DataFrame:
    """``doc_id, text_hash, n_words, n_removed, kept`` for each row; ``kept`` are UTF-8 bytes."""
    table, n = chunked(docs, chars)
    parts = -(-n // CHUNKS_PER_PART)
    sent = table.groupBy("chunk").applyInPandas(lambda c: send_symbols(c, parts, window, rounds), MESSAGE)
    shared = sent.groupBy("part").applyInPandas(lambda r: answers(r, False), ANSWER)
    due = table.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInPandas(lambda c, a: send_windows(c, a, parts, window, rounds), MESSAGE)
    earlier = due.groupBy("part").applyInPandas(lambda r: answers(r, True), ANSWER)
    return table.groupBy("chunk").cogroup(earlier.groupBy("chunk")).applyInPandas(
        lambda c, a: remove(c, a, window), "doc_id long, text_hash long, n_words long, n_removed long, kept binary"
    )


def report(docs: DataFrame, **options) -> DataFrame:
    return without_repeats(docs, **options).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
