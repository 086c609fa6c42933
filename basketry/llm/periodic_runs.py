"""Periodic runs of words, solved in tiles for each octave of periods.

For every octave of periods ``[b, 2b)`` a document is cut into overlapping tiles, and every tile is
searched alone. A run of period q and four periods or more matches itself, q words on, over at
least 3b words, so it fills two neighbouring aligned blocks of b words: hashes of all windows of b
words, laid out b to a row, show each block that comes again q words later by one comparison of
rows. Chains of such blocks are the inner part of a run; boundary Z-functions of the words before
the first and after the last block give its ends. A chain whose period is a multiple of a smaller
one of the same stretch is left out. What a tile finds is a fragment: an interval of places that
match q words on. Fragments are shuffled by document and period, touching ones are stitched, and
stitched intervals of enough words are the runs, whatever the tiles were.

A document that fits in one tile is solved where it is read; tiles of longer ones become rows of
their own and are dealt to all tasks. Only documents with a fragment keep their text for the
second step.

Defined cases: null or empty text has no words and no runs; each row of documents is judged for
itself, also where ids repeat or are null; an empty table gives an empty result. Words are compared
by 64-bit hashes. Only ``doc_id`` and ``text`` are read, so extra columns clash with nothing.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.frames import WORD, bounded_batches, parallelism, stored
from basketry.llm.textual import mixed, powers, slices, texts_of, words

LEAST_WORDS = 6  # of a run
LEAST_PERIODS = 4
TILE = 1 << 16  # words of one octave solved at once, at least eight blocks

FRAGMENT = "array<struct<period:long,lo:long,hi:long>>"


def z_function(s: list) -> list[int]:
    """Length of the longest common prefix of the sequence and each of its suffixes."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    if n:
        z[0] = n
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def prime_factors(q: int) -> set[int]:
    found, p = set(), 2
    while p * p <= q:
        while q % p == 0:
            found.add(p)
            q //= p
        p += 1
    return found | ({q} if q > 1 else set())


class Sequence:
    """Word codes with prefix sums, so that hashes of any ranges are compared at once."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        power, self.inverse = powers("word", len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * power[:-1], out=self.sums[1:])

    def hash(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return (self.sums[hi] - self.sums[lo]) * self.inverse[lo]

    def blocks(self, b: int, n: int) -> np.ndarray:
        """Hashes of the windows of ``b`` words among the first ``n``, in rows of ``b``; windows
        that would run over the end have values of their own."""
        rows = -(-n // b) + 1
        h = mixed(np.arange(rows * b, dtype=np.uint64) + np.uint64(0xB10C << 44))
        m = max(n - b + 1, 0)
        h[:m] = (self.sums[b : n + 1] - self.sums[:m]) * self.inverse[:m]
        return h.reshape(rows, b)


def _by_place(at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each place once, with the numbers of the chains that have it."""
    order = np.argsort(at, kind="stable")
    cuts = np.flatnonzero(np.diff(at[order])) + 1
    for own in np.split(order, cuts) if len(at) else ():
        yield int(at[own[0]]), own


def left_ends(codes: np.ndarray, b: int, at: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How far the words before ``at`` match those ``period`` words on, up to ``b`` words."""
    out = np.zeros(len(at), np.int64)
    for c, own in _by_place(at):
        before = codes[max(0, c - b) : c][::-1].tolist()
        after = codes[c : c + 2 * b][::-1].tolist()
        z = z_function([*before, None, *after])
        out[own] = [min(z[len(before) + 1 + len(after) - q], len(before)) for q in period[own]]
    return out


def right_ends(codes: np.ndarray, b: int, at: np.ndarray, period: np.ndarray) -> np.ndarray:
    """How far the words from ``at`` on match those ``period`` words on, up to ``b`` words."""
    out = np.zeros(len(at), np.int64)
    for c, own in _by_place(at):
        here = codes[c : c + b].tolist()
        z = z_function([*here, None, *codes[c + b : c + 3 * b].tolist()])
        z += [0] * (len(here) + 2 * b)
        out[own] = [z[len(here) + 1 + q - b] for q in period[own]]
    return out


def primitive(s: Sequence, b: int, at: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether the stretch of ``period + b`` words from ``at`` has no period that divides it."""
    good = np.ones(len(at), bool)
    distinct, which = np.unique(period, return_inverse=True)
    by_prime: dict[int, list[int]] = {}
    for k, q in enumerate(distinct):
        for r in prime_factors(int(q)):
            by_prime.setdefault(r, []).append(k)
    for r, of in by_prime.items():
        due = np.flatnonzero(np.isin(which, of) & good)
        lo, q = at[due], period[due]
        hi, p = lo + q + b, q // r
        good[due] = s.hash(lo, hi - p) != s.hash(lo + p, hi)
    return good


def fragments(s: Sequence, b: int, n: int, edges: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Period and interval of matching places of the stretches of the octave ``[b, 2b)`` among the
    first ``n`` words. With ``edges`` a stretch that reaches an end is given however short."""
    none = (np.empty(0, np.int64),) * 3
    rows = s.blocks(b, n)
    equal = rows[1:] == rows[:-1, :1]
    hit = equal[:-1] & equal[1:]
    if not hit.any():
        return none
    row, column = np.nonzero(hit)
    order = np.lexsort((row, column))
    row, period = row[order], column[order] + b
    new = np.ones(len(row), bool)
    new[1:] = (period[1:] != period[:-1]) | (row[1:] != row[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    lo, hi, period = row[first] * b, (row[last] + 2) * b, period[first]
    need = np.maximum((LEAST_PERIODS - 1) * period, LEAST_WORDS - period)
    able = hi - lo + 2 * b > need
    if edges:
        able |= (lo <= b) | (hi + period + b >= n)
    able[able] = primitive(s, b, lo[able], period[able])
    lo, hi, period, need = lo[able], hi[able], period[able], need[able]
    lo = lo - left_ends(s.codes[:n], b, lo, period)
    hi = hi + right_ends(s.codes[:n], b, hi, period)
    whole = hi - lo >= need
    if edges:
        whole |= (lo == 0) | (hi + period >= n)
    return period[whole], lo[whole], hi[whole]


def octaves(n: int) -> Iterator[int]:
    """First periods of the octaves that a document of ``n`` words can hold a run of."""
    b = 1
    while n >= LEAST_WORDS and LEAST_PERIODS * b <= n:
        yield b
        b *= 2


def tiles(n: int, b: int, tile: int) -> Iterator[tuple[int, int]]:
    """Overlapping tiles of a document for one octave, aligned to its blocks."""
    step = max(tile // b, 8) * b
    for at in range(0, n, step):
        yield max(0, at - b), min(n, at + step + 4 * b)
        if at + step + 4 * b >= n:
            return


def solve_whole(codes: np.ndarray, first: np.ndarray, chosen: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """The stretches of the chosen documents of a batch, all of them searched together.

    The longest come first, so an octave looks at the documents that can hold it. Values between
    documents equal nothing, so nothing reaches over them.
    """
    sizes = np.diff(first)
    chosen = chosen[sizes[chosen] >= LEAST_WORDS]
    chosen = chosen[np.argsort(-sizes[chosen], kind="stable")]
    if not len(chosen):
        return {}
    begins = np.concatenate([[0], np.cumsum(sizes[chosen] + 1)])
    joined = mixed(np.arange(begins[-1], dtype=np.uint64) + np.uint64(0x5E9 << 48))
    for d, at in zip(chosen, begins, strict=False):
        joined[at : at + sizes[d]] = codes[first[d] : first[d + 1]]
    s, found = Sequence(joined), {}
    for b in octaves(int(sizes[chosen[0]])):
        fit = int(np.searchsorted(-sizes[chosen], -LEAST_PERIODS * b, "right"))
        period, lo, hi = fragments(s, b, int(begins[fit]), False)
        of = np.searchsorted(begins, lo, "right") - 1
        for d, p, x, y in zip(chosen[of].tolist(), period.tolist(), (lo - begins[of]).tolist(), (hi - begins[of]).tolist(), strict=True):
            found.setdefault(d, []).append((p, x, y))
    return found


_PIECE = f"row long, n_words long, sha string, words binary, fragments {FRAGMENT}, octave long, at long, codes binary"


def _pieces(docs: DataFrame, tile: int) -> DataFrame:
    """A row for each document, and one for each tile of the documents longer than a tile.

    A document without a fragment has the digest of its words, the others carry the words.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), itertools.count()
        schema = pa.schema(
            [("row", pa.int64()), ("n_words", pa.int64()), ("sha", pa.string()), ("words", pa.binary()),
             ("fragments", pa.list_(pa.struct([(c, pa.int64()) for c in ("period", "lo", "hi")]))), ("octave", pa.int64()), ("at", pa.int64()), ("codes", pa.binary())]
        )
        for batch in batches:
            ids = batch.column(0)
            for i, j, texts in slices(texts_of(batch.column(1))):
                w = words(texts)
                rows = [part << 33 | next(number) for _ in range(j - i)]
                found = solve_whole(w.hash, w.first, np.flatnonzero(w.counts <= tile))
                out = {"row": rows, "n_words": w.counts.tolist(), "sha": [], "words": [], "fragments": [], "octave": [None] * (j - i), "at": [None] * (j - i), "codes": [None] * (j - i)}
                for d in range(j - i):
                    joined = b" ".join(texts.data[texts.at[d] : texts.at[d + 1]].tobytes().split())
                    keep = d in found or w.counts[d] > tile
                    out["words"].append(joined if keep else None)
                    out["sha"].append(None if keep else hashlib.sha256(joined).hexdigest())
                    out["fragments"].append([dict(zip(("period", "lo", "hi"), f, strict=True)) for f in found.get(d, ())])
                of_doc = pa.RecordBatch.from_pydict(out, schema)
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), *of_doc.columns], ["doc_id", *schema.names])
                for d in np.flatnonzero(w.counts > tile):
                    codes = w.hash[w.first[d] : w.first[d + 1]]
                    for b in octaves(len(codes)):
                        for lo, hi in tiles(len(codes), b, tile):
                            one = {"row": [rows[d]], "n_words": [len(codes)], "sha": [None], "words": [None], "fragments": [None], "octave": [b], "at": [lo], "codes": [codes[lo:hi].tobytes()]}
                            of_tile = pa.RecordBatch.from_pydict(one, schema)
                            yield pa.RecordBatch.from_arrays([ids.slice(i + d, 1), *of_tile.columns], ["doc_id", *schema.names])

    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return stored(rows.mapInArrow(cut, f"doc_id {kind}, {_PIECE}"), "periodic-pieces")


def _solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row, b, at, n = (batch.column(c)[k].as_py() for c in ("row", "octave", "at", "n_words"))
            codes = np.frombuffer(batch.column("codes")[k].as_buffer(), np.uint64)
            period, lo, hi = fragments(Sequence(codes), b, len(codes), len(codes) < n)
            yield pa.RecordBatch.from_pydict({"row": pa.array([row] * len(lo), pa.int64()), "period": period, "lo": lo + at, "hi": hi + at})


def stitch(found: DataFrame) -> DataFrame:
    """Runs ``row, start, length, period`` from fragments ``row, period, lo, hi``."""
    by = Window.partitionBy("row", "period").orderBy("lo", "hi")
    reach = F.max("hi").over(by.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce((F.col("lo") > reach).cast("int"), F.lit(0))
    marked = found.withColumn("apart", apart).withColumn("island", F.sum("apart").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    whole = marked.groupBy("row", "period", "island").agg(F.min("lo").alias("start"), (F.max("hi") - F.min("lo") + F.col("period")).alias("length"))
    long_enough = F.col("length") >= F.greatest(F.lit(LEAST_WORDS), LEAST_PERIODS * F.col("period"))
    return whole.filter(long_enough).select("row", "start", "length", "period")


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, runs = [], batch.column("runs").to_pylist()
        for text, own in zip(batch.column("words"), runs, strict=True):
            parts = text.as_py().split()
            change = np.zeros(len(parts) + 1, np.int64)
            for r in own or ():
                change[r["start"] + r["period"]] += 1
                change[r["start"] + r["length"]] -= 1
            left = np.cumsum(change[:-1]) == 0
            kept.append(b" ".join(itertools.compress(parts, left)))
        columns = [batch.column(c) for c in ("doc_id", "n_words", "runs")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary())], ["doc_id", "n_words", "runs", "kept"])


def find_runs(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """``doc_id, n_words, runs, kept, kept_sha256`` for each row of the documents.

    ``runs`` are ``(start, period, length)`` by start, then period. ``kept`` holds the words that
    are left if every run is collapsed to its first period, joined by spaces; it is null for a
    document that no stretch was found in, whose words all stay.
    """
    pieces = _pieces(docs, tile)
    whole = pieces.filter("octave IS NULL")
    dealt = pieces.filter("octave IS NOT NULL").select("row", "n_words", "octave", "at", "codes").repartition(parallelism(docs.sparkSession))
    apart = whole.select("row", F.explode("fragments").alias("f")).select("row", "f.period", "f.lo", "f.hi")
    found = apart.unionByName(dealt.mapInArrow(_solve_tiles, "row long, period long, lo long, hi long"))
    run = F.struct("start", "period", "length")
    runs = stitch(found).groupBy("row").agg(F.sort_array(F.collect_list(run)).alias("runs"))
    with_words = whole.filter("words IS NOT NULL").select("row", "doc_id", "n_words", "words").join(runs, "row", "left")
    kind = docs.schema["doc_id"].dataType.simpleString()
    run_type = "array<struct<start:long,period:long,length:long>>"
    some = with_words.select("doc_id", "n_words", "words", "runs").mapInArrow(_collapse, f"doc_id {kind}, n_words long, runs {run_type}, kept binary")
    none = whole.filter("words IS NULL").select("doc_id", "n_words", F.lit(None).cast(run_type).alias("runs"), F.lit(None).cast("binary").alias("kept"), F.col("sha").alias("kept_sha256"))
    both = some.withColumn("kept_sha256", F.sha2("kept", 256)).unionByName(none)
    return both.withColumn("runs", F.coalesce("runs", F.array().cast(run_type)))


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where a tenth of the documents, by a hash of the id, ends in a repetition.

    It takes the place of the words from the a-th on and repeats the p words there. A document
    without id is left as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    )
    g, n = F.floor(F.col("h") / 10), F.size("w").cast("long")
    sized = chosen.withColumn("n", n).withColumn("g", g).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    left = F.col("n") - F.col("a")
    p = (1 + F.floor(left / (3 + F.col("g") % 8))).cast("int")
    head = F.slice("w", F.lit(1), F.col("a").cast("int"))
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a").cast("int") + 1, p), F.ceil(left / p).cast("int")))
    text = F.array_join(F.concat(head, F.slice(again, F.lit(1), left.cast("int"))), " ")
    return sized.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def _text(x: Column) -> Column:
    return F.concat(*(c if i == 0 else F.concat(F.lit(","), c) for i, c in enumerate(x[f].cast("string") for f in ("start", "length", "period"))), F.lit("\n"))


def report(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """The runs of the documents, some of which end in a repetition of their own (``planted``)."""
    found = find_runs(planted(docs), tile)
    longest = F.array_max(F.transform("runs", lambda x: F.struct(x["length"].alias("length"), (-x["start"]).alias("start"), (-x["period"]).alias("period"))))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", _text), "").cast("binary"), 256).alias("runs_sha256"),
        F.col("kept_sha256").alias("collapsed_sha256"),
    )
