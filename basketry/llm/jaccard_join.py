"""N-gram Jaccard self-join: rare-first prefix filtering, verified once per pair.

1. Frequent n-grams are counted over the whole corpus (those that repeat within a slice of a few
   MB); the ``ORDER_SIZE`` most frequent ones form a table of fixed size that is broadcast. It only
   sets an order, rare n-grams first and equal ranks by hash; any order gives the same links.
2. Each text becomes its set of n-gram hashes; texts with equal sets are one node, represented
   once. Only the rare-first prefix of the set, its size and a small histogram are kept.
3. Prefix n-grams held by two or more nodes give candidate pairs under the length and positional
   filters; the suffix filter bounds the symmetric difference by the histograms. Sets of the
   remaining nodes are computed from the texts and each pair is intersected once.
4. A prefix n-gram that many near copies share would give all pairs of them. Instead each node is
   first paired with the group's first node only. Links give components. In rounds, nodes outside
   the largest component of a large group then meet some of ``PIVOTS`` members drawn by hash, other
   ones each round, as long as a round ties a quarter of them to it. Afterwards those still outside are
   paired with all of the group's nodes of other components. Pairs inside a component cannot
   change it, so every component is exact; the rounds only leave fewer pairs to the last step.
   There a pair that shares several n-grams of large groups is formed at the first of them (all but
   a few repeats are seen by the ``BEFORE`` n-grams that a node carries along); groups of at most
   ``PIVOTS`` nodes are one row each, and only the pairs that pass the filters leave it.
5. The number of links of each row needs every pair: ``all_links`` forms the pairs of all nodes as the
   last step does, at their first shared n-gram, and verifies each. Near copies then cost their square.

Groups are never gathered: per-group facts are pre-aggregated, joins on hot n-grams are split by
adaptive execution, and a node with many partners is verified in salted blocks. Sets are sent to the
blocks in turns, each with a scan of the texts instead of a shuffle of them, so that a share of the sets
lies there at a time. Tables and shuffles go as soon as no later step reads them.

Defined cases: null or empty text is an empty set, linked with nothing and its own component; rows
with equal texts are linked whatever their ids; rows without doc_id are linked like others but lend
no id: a component of such rows only has a null id; repeated rows each get a row; an empty table
gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.frames import bounded_batches, discard, small, stored, text_key
from basketry.llm.textual import Texts, grouped, lists, lowered, mixed, ranges, slices, texts_of, windows, words
from basketry.streaming.log import release

SHINGLE = 3
PERCENT = 90
ORDER_SIZE = 1 << 18  # n-grams in the broadcast order: 4 MB
LOCAL_REPEATS = 3
COUNT_SLICE = 2 << 20  # bytes of text in which an n-gram must repeat to be counted
BINS = 64
MOST = 32_767  # a bin counts no further: distances of longer sets only get smaller
PIVOTS = 32  # members that nodes of a larger group meet in a round
TRIES = 2  # of these, the nearest by histogram and as many by hash that a node is verified against
BEFORE = 8  # earlier n-grams of open groups by which a repeated pair is told
BLOCK = 500  # partners verified against one node by one task
BROADCAST_ROWS = 1_000_000  # rows of three numbers, 24 MB; more are joined by sorting
# Prefixes and sets are shuffled in up to so many turns, of so many bytes and rows each where these turns suffice.
TURNS, TURN_BYTES, TURN_ROWS = 8, 256 << 20, BROADCAST_ROWS // 2
PREFIX_BYTES = 32  # of a prefix n-gram and its node, shuffled twice


def shingles(texts: Texts, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-gram hashes: the text of each, its hash, sorted by both; set sizes."""
    w = words(lowered(texts))
    lo, h = windows(w, k)
    of = w.text_of()[lo]
    short = np.flatnonzero((w.counts > 0) & (w.counts < k))
    of = np.concatenate([of, short])
    h = np.concatenate([h, ranges(w.hash, w.first[short], w.first[short + 1])])
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    of, h = of[new], h[new]
    return of, h, np.bincount(of, minlength=len(w.counts))


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """Shared n-grams that a partner of a set of this size must have."""
    return -(-n * percent // 100)


def frequent(docs: DataFrame, k: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams, sorted by hash, and their rank (rarest first)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in slices(texts_of(batch.column(0)), COUNT_SLICE):
                _, h, _ = shingles(texts, k)
                h.sort()
                first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
                n = np.diff(np.append(first, len(h)))
                often = n >= LOCAL_REPEATS
                yield pa.RecordBatch.from_pydict({"gram": pa.array(h[first[often]].view(np.int64)), "n": pa.array(n[often])})

    counts = docs.select(F.col("text").cast("binary")).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "gram").limit(size).toPandas()  # bounded by ``size``
    gram, n = top["gram"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    rank = np.empty(len(n), np.int64)
    rank[np.lexsort((gram, n))] = np.arange(1, len(n) + 1)
    order = np.argsort(gram)
    return gram[order], rank[order]


def signatures(docs: DataFrame, k: int, percent: int, order: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``doc_id, text_hash, n, sig, check, prefix, bins`` for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value
        for batch in batches:
            for i, j, texts in slices(texts_of(batch.column(2))):
                of, h, n = shingles(texts, k)
                at = np.concatenate([[0], np.cumsum(n)])
                ranks = np.zeros(len(h), np.int64)
                if len(known) and len(h):
                    place = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    ranks = np.where(known[place] == h, rank[place], 0)
                ranked = np.lexsort((h, ranks, of))
                length = np.where(n > 0, n - least_overlap(n, percent) + 1, 0)
                number = np.arange(len(h)) - at[of]
                prefix = h[ranked][number < length[of]]
                total = np.zeros((2, len(h) + 1), np.uint64)
                np.cumsum(mixed(h), out=total[0, 1:])
                np.cumsum(mixed(h * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)), out=total[1, 1:])
                sig, check = (mixed((t[at[1:]] - t[at[:-1]]) + n.astype(np.uint64)).view(np.int64) for t in total)
                bins = np.bincount(of * BINS + (h >> np.uint64(58)).astype(np.int64), minlength=len(n) * BINS)
                bins = np.minimum(bins, MOST).astype(np.int16)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0).slice(i, j - i), "text_hash": batch.column(1).slice(i, j - i), "n": pa.array(n.astype(np.int64)),
                        "sig": pa.array(sig), "check": pa.array(check), "prefix": lists(pa.array(prefix.view(np.int64)), length),
                        "bins": lists(pa.array(bins), np.full(len(n), BINS)),
                    }
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_key().alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(sign, f"doc_id {kind}, text_hash long, n long, sig long, check long, prefix array<long>, bins array<smallint>")


def linked(overlap: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * overlap >= percent * (a + b - overlap)


def distance(a: Column, b: Column) -> Column:
    """Distance of two histograms: at most the symmetric difference of the sets."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x.cast("int") - y.cast("int"))), F.lit(0), lambda s, x: s + x)


def suffix_filter(a: Column, b: Column, na: Column, nb: Column, percent: int) -> Column:
    """Whether the symmetric difference, at least the distance of the histograms, is small enough.

    A link needs an overlap of ``percent * (na + nb) / (100 + percent)`` at least.
    """
    return (100 + percent) * (na + nb - distance(a, b)) >= 2 * percent * (na + nb)


def positional(na: Column, nb: Column, i: Column, j: Column, percent: int) -> Column:
    """Length and positional filter, for the first n-gram that two sets share."""
    most = F.least(na - i, nb - j)
    length = (100 * F.least(na, nb) >= percent * F.greatest(na, nb))
    return length & ((100 + percent) * most >= percent * (na + nb))


def turns_of(size: int, rows: int = 0) -> int:
    """In how many turns so many bytes and rows are shuffled."""
    return min(TURNS, max(1, -(-size // TURN_BYTES), -(-rows // TURN_ROWS)))


def together(parts: list[DataFrame], label: str) -> DataFrame:
    """Stored frames as one."""
    if len(parts) == 1:
        return parts[0]
    whole = stored(reduce(DataFrame.unionByName, parts), label)
    discard(*parts)
    return whole


def components(edges: DataFrame) -> DataFrame:
    """``node, comp``: the least node reachable, for every node with an edge.

    Rounds of least-neighbour labels and pointer jumping, each written to the scratch folder.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    label = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("comp")), "labels")
    read = [both, label]
    while True:
        near = both.join(label, both["b"] == label["node"]).groupBy("a").agg(F.min("comp").alias("near"))
        hooked = label.join(near, label["node"] == near["a"]).select("node", F.least("comp", "near").alias("new"), F.col("comp").alias("old"))
        up = label.select(F.col("node").alias("up_node"), F.col("comp").alias("up"))
        jumped = hooked.join(up, hooked["new"] == up["up_node"]).select("node", F.least("new", "up").alias("comp"), "old")
        following = stored(jumped, "labels")
        label = following.select("node", "comp")
        if following.filter("comp <> old").isEmpty():
            discard(*read)
            return label
        read.append(following)


class Join:
    """The steps of one run; each step's table is written once and read by the later ones."""

    def __init__(self, docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, order_size: int = ORDER_SIZE):
        bounded_batches(docs.sparkSession)
        self.docs, self.k, self.percent = docs, k, percent
        signed = stored(signatures(docs, k, percent, frequent(docs, k, order_size)), "signatures")
        # One row names the node and lends its text: that of the least id, one without id only where there is no other.
        order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
        one = F.min_by(F.struct(F.col("doc_id").alias("least_id"), "text_hash", "prefix", "bins"), order)
        nodes = signed.filter("n > 0").groupBy("sig", "check", "n").agg(one.alias("one"), F.count("*").alias("copies"))
        nodes = nodes.select("sig", "check", "n", "copies", "one.*").withColumn("node", F.monotonically_increasing_id())
        self.nodes = stored(nodes, "nodes")
        self.rows = stored(signed.select("doc_id", "text_hash", "n", "sig", "check"), "rows")
        discard(signed)

    def held(self) -> DataFrame:
        """A row for each prefix n-gram held by two or more nodes: ``gram, node, n, pos, size``.

        N-grams have their turns by hash. The nodes go on without their prefixes, which only this step reads.
        """
        entries = self.nodes.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()[0]
        turns = turns_of(PREFIX_BYTES * entries)
        found = []
        for turn in range(turns):
            each = self.nodes.select("node", "n", F.posexplode("prefix").alias("pos", "gram")).filter(F.pmod("gram", F.lit(turns)) == turn)
            held = each.groupBy("gram").agg(F.count("*").alias("size")).filter("size > 1")
            release(each.sparkSession)
            found.append(stored(each.join(held, "gram"), "grams"))
        grams = together(found, "grams")
        whole, self.nodes = self.nodes, stored(self.nodes.drop("prefix"), "nodes")
        discard(whole)
        return grams

    def grams(self, grams: DataFrame) -> DataFrame:
        """The rows of ``held``, each with the ``first`` node of its n-gram."""
        return grams.join(grams.groupBy("gram").agg(F.min(F.struct("n", "node", "pos")).alias("first")), "gram")

    def near(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b`` that pass the suffix filter, and how ``far`` their histograms are apart."""
        x = self.nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bins").alias("bins_a"))
        y = self.nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bins").alias("bins_b"))
        both = pairs.join(x, "a").join(y, "b")
        near = both.filter(suffix_filter(F.col("bins_a"), F.col("bins_b"), F.col("na"), F.col("nb"), self.percent))
        return near.select("a", "b", distance(F.col("bins_a"), F.col("bins_b")).alias("far"))

    def close(self, pairs: DataFrame) -> DataFrame:
        """Distinct candidate pairs ``a, b`` that pass the suffix filter."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        return stored(self.near(pairs).select("a", "b"), "candidates")

    def sets(self, wanted: DataFrame) -> DataFrame:
        """``node, grams`` of the wanted nodes, from the text of one of their rows."""
        of = self.nodes.join(wanted, "node").select("node", F.col("least_id").alias("w_id"), F.col("text_hash").alias("w_hash"))
        of = small(stored(of, "wanted"), BROADCAST_ROWS)
        text = self.docs.select("doc_id", text_key().alias("text_hash"), F.col("text").cast("binary").alias("text"))
        found = text.join(of, text["doc_id"].eqNullSafe(of["w_id"]) & (text["text_hash"] == of["w_hash"])).select("node", "text")
        k = self.k

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, j, texts in slices(texts_of(batch.column(1))):
                    _, h, n = shingles(texts, k)
                    at = np.concatenate([[0], np.cumsum(n)])
                    grams = [h[at[x] : at[x + 1]].tobytes() for x in range(j - i)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(grams, pa.binary())], ["node", "grams"])

        # Repeated rows go after the sets are built: this exchange also serves the join on the node.
        return found.mapInArrow(build, "node long, grams binary").dropDuplicates(["node"])

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are links, stored. Partners of a node are verified in salted blocks.

        Of a pair the node with more pairs is the head of the block: its set is sent once for all.
        Blocks have their turns, so that the sets of all never lie there at once.
        """
        degree = pairs.select(F.explode(F.array("a", "b")).alias("of")).groupBy("of").agg(F.count("*").alias("degree"))
        x, y = (degree.select(F.col("of").alias(c), F.struct("degree", "of").alias(f"of_{c}")) for c in "ab")
        pairs = pairs.join(x, "a").join(y, "b").select(F.greatest("of_a", "of_b")["of"].alias("a"), F.least("of_a", "of_b")["of"].alias("b"))
        sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("salts"))
        blocks = pairs.join(sizes, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
        heads = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("a").alias("node"), F.lit(True).alias("head"))
        due = stored(heads.unionByName(blocks.select("a", "salt", F.col("b").alias("node"), F.lit(False).alias("head"))), "due")
        rows, grams = due.join(self.nodes.select("node", "n"), "node").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        turns = turns_of(8 * grams, rows)
        percent = self.percent

        def intersect(rows: pd.DataFrame) -> pd.DataFrame:
            head = np.frombuffer(rows.loc[rows["head"], "grams"].iloc[0], np.uint64)
            links = []
            for node, raw in rows.loc[~rows["head"], ["node", "grams"]].itertuples(index=False):
                other = np.frombuffer(raw, np.uint64)
                shared = len(np.intersect1d(head, other, assume_unique=True))
                if 100 * shared >= percent * (len(head) + len(other) - shared):
                    links.append(node)
            return pd.DataFrame({"a": np.full(len(links), rows["a"].iloc[0]), "b": np.array(links, np.int64)})

        found = []
        for turn in range(turns):
            own = due.filter(F.pmod(F.xxhash64("a", "salt"), F.lit(turns)) == turn)
            sets = own.join(self.sets(own.select("node").distinct()), "node")
            release(due.sparkSession)
            found.append(stored(sets.groupBy("a", "salt").applyInPandas(intersect, "a long, b long"), "links"))
        discard(due)
        return together(found, "links")

    def open_groups(self, grams: DataFrame, comps: DataFrame) -> tuple[DataFrame, int]:
        """Members of groups of several components, and how many lie outside the largest in large groups.

        Groups of two have no further pair than that with their first node.
        """
        named = grams.filter("size > 2").drop("first").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        per = named.groupBy("gram", "comp").agg(F.count("*").alias("members"))
        whole = per.groupBy("gram").agg(F.count("*").alias("kinds"), F.max(F.struct("members", "comp")).alias("most")).filter("kinds > 1")
        members = stored(named.join(whole.select("gram", F.col("most.comp").alias("main")), "gram"), "open-groups")
        return members, members.filter((F.col("size") > PIVOTS) & (F.col("comp") != F.col("main"))).count()

    def pivot_pairs(self, members: DataFrame, turn: int) -> DataFrame:
        """Candidate pairs ``a, b`` of nodes outside the largest component and a few members of their group.

        Of the members drawn that pass the filters a node meets those it shares most prefix n-grams with,
        and takes the nearest and a few drawn by hash, which tie groups of even nearer copies together;
        what they leave apart is left to later steps. Histograms are looked up for those it meets only.
        """
        large = members.filter(F.col("size") > PIVOTS).select("gram", "node", "n", "pos", "comp", "main")
        drawn = large.withColumn("draw", F.xxhash64("node", F.lit(turn)))
        slots = drawn.groupBy("gram", F.pmod("draw", F.lit(PIVOTS)).alias("slot")).agg(F.min(F.struct("draw", "node", "n", "pos", "comp")).alias("one"))
        pivots = slots.groupBy("gram").agg(F.collect_list("one").alias("pivots"))

        def passing(p: Column) -> Column:
            return (p["comp"] != F.col("comp")) & positional(F.col("n"), p["n"], F.col("pos"), p["pos"], self.percent)

        met = large.filter("comp <> main").join(pivots, "gram").select(F.col("node").alias("a"), F.explode(F.filter("pivots", passing)["node"]).alias("b"))
        often = met.groupBy("a", "b").agg((-F.count("*")).alias("shared")).groupBy("a").agg(F.sort_array(F.collect_list(F.struct("shared", "b"))).alias("all"))
        near = self.near(often.select("a", F.explode(F.slice("all", 1, PIVOTS)["b"]).alias("b"))).groupBy("a").agg(F.collect_list(F.struct("far", "b")).alias("near"))
        again = F.transform("near", lambda p: F.struct(F.xxhash64(p["b"], "a", F.lit(turn)).alias("far"), p["b"].alias("b")))
        tried = F.concat(*(F.slice(F.array_sort(c)["b"], 1, TRIES) for c in (F.col("near"), again)))
        each = near.select("a", F.explode(F.array_distinct(tried)).alias("b"))
        return each.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def small_group_pairs(self, members: DataFrame) -> DataFrame:
        """Pairs ``a, b`` of different components that pass the filters within groups of at most ``PIVOTS`` nodes.

        Such a group is one row, so that only pairs that pass leave it.
        """
        groups = members.filter(F.col("size") <= PIVOTS).groupBy("gram").agg(F.collect_list(F.struct("node", "n", "pos", "comp")).alias("all"))
        each = groups.select("all", F.explode("all").alias("x"))
        x = F.col("x")

        def passing(y: Column) -> Column:
            return (x["comp"] != y["comp"]) & (x["node"] < y["node"]) & positional(x["n"], y["n"], x["pos"], y["pos"], self.percent)

        met = each.select(x["node"].alias("a"), F.filter("all", passing).alias("near"))
        return met.select("a", F.explode(F.col("near.node")).alias("b"))

    def remaining_pairs(self, members: DataFrame) -> DataFrame:
        """All candidate pairs ``a, b`` of nodes outside the largest component of their group with other components.

        Here every member of a group counts, so the histograms go along: one for each row of a group,
        not for each pair, and only pairs that pass all filters leave the join.
        """
        few = self.small_group_pairs(members)
        earlier = Window.partitionBy("node").orderBy("pos").rowsBetween(-BEFORE, -1)
        members = members.filter(F.col("size") > PIVOTS)
        members = members.withColumn("before", F.collect_list("gram").over(earlier)).join(self.nodes.select("node", "bins"), "node")
        parts = ("node", "n", "pos", "comp", "bins", "before")
        x = members.filter("comp <> main").select("gram", *(F.col(c).alias(f"x_{c}") for c in parts))
        y = members.select("gram", *(F.col(c).alias(f"y_{c}") for c in parts), (F.col("comp") == F.col("main")).alias("y_main"))
        pairs = x.join(y, "gram").filter(
            (F.col("x_comp") != F.col("y_comp")) & (F.col("y_main") | (F.col("x_node") < F.col("y_node")))
            & positional(F.col("x_n"), F.col("y_n"), F.col("x_pos"), F.col("y_pos"), self.percent)
            & ~F.arrays_overlap("x_before", "y_before")
            & suffix_filter(F.col("x_bins"), F.col("y_bins"), F.col("x_n"), F.col("y_n"), self.percent)
        )
        many = pairs.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b"))
        return many.unionByName(self.close(few)).distinct()

    def links(self) -> tuple[DataFrame, DataFrame]:
        """Verified pairs of nodes, enough to connect every component, and the components."""
        held = self.held()
        grams = self.grams(held)
        star = grams.filter(F.col("node") != F.col("first.node")).filter(
            positional(F.col("n"), F.col("first.n"), F.col("pos"), F.col("first.pos"), self.percent)
        )
        tried = self.close(star.select(F.col("node").alias("a"), F.col("first.node").alias("b")))
        found = self.verify(tried)
        comps = components(found)
        members, outside = self.open_groups(grams, comps)
        turn, before = 0, 2 * outside
        while 0 < outside <= 0.75 * before:
            turn, before = turn + 1, outside
            pairs = stored(self.pivot_pairs(members, turn).join(tried, ["a", "b"], "left_anti"), "pivot-candidates")
            new = self.verify(pairs)
            if new.isEmpty():
                break
            tried, found = tried.unionByName(pairs), found.unionByName(new)
            discard(members)
            comps = components(found)
            members, outside = self.open_groups(grams, comps)
        rest = stored(self.remaining_pairs(members).join(tried, ["a", "b"], "left_anti"), "more-candidates")
        discard(members, held)
        new = self.verify(rest)
        if new.isEmpty():
            return found, comps
        every = found.unionByName(new)
        return every, components(every)

    def all_links(self) -> DataFrame:
        """Every link ``a, b`` of two nodes: each pair that passes the filters is verified, once.

        Every node counts as its own component here, so no pair is left out as connected already.
        """
        held = self.held()
        apart = held.withColumn("comp", F.col("node")).withColumn("main", F.lit(-1).cast("long"))
        pairs = stored(self.remaining_pairs(apart), "all-candidates")
        discard(held)
        return self.verify(pairs)

    def classes(self, counted: bool = False) -> DataFrame:
        """``doc_id, text_hash, n_shingles, component_id`` for each row.

        ``counted`` verifies every pair and adds ``n_links``, the number of other rows linked with a row.
        """
        found = self.all_links() if counted else None
        comps = components(found) if counted else self.links()[1]
        named = self.nodes.select("sig", "check", "n", "copies", "least_id", "node").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        least = named.groupBy("comp").agg(F.min("least_id").alias("component_id"))
        if counted:
            weights = self.nodes.select(F.col("node").alias("b"), F.col("copies").alias("other"))
            linked = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(weights, "b").groupBy(F.col("a").alias("node")).agg(F.sum("other").alias("others"))
            named = named.join(linked, "node", "left").withColumn("l_links", F.col("copies") - 1 + F.coalesce("others", F.lit(0)))
        more = ["l_links"] if counted else []
        label = named.join(least, "comp").select(F.col("sig").alias("l_sig"), F.col("check").alias("l_check"), F.col("n").alias("l_n"), "component_id", *more)
        rows = self.rows.select("doc_id", "text_hash", "n", "sig", "check")
        joined = rows.join(label, F.expr("n > 0 AND sig = l_sig AND check = l_check AND n = l_n"), "left")
        component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
        links = [F.coalesce("l_links", F.lit(0)).alias("n_links")] if counted else []
        return joined.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), component, *links)


def report(docs: DataFrame, **options) -> DataFrame:
    return Join(docs, **options).classes().drop("text_hash")


def report_links(docs: DataFrame, **options) -> DataFrame:
    return Join(docs, **options).classes(counted=True).drop("text_hash")


def clean(docs: DataFrame, **options) -> DataFrame:
    """One document of each component, the one with the least id; all rows without an id stay."""
    join = Join(docs, **options)
    classes = join.classes()
    gone = classes.filter("doc_id <> component_id").select(F.col("doc_id").alias("g_id"), F.col("text_hash").alias("g_hash")).distinct()
    gone = stored(gone, "gone")
    discard(join.rows, join.nodes)
    gone = small(gone, BROADCAST_ROWS)
    left = docs.join(gone, docs["doc_id"].eqNullSafe(gone["g_id"]) & (text_key() == gone["g_hash"]), "left_anti")
    return left
