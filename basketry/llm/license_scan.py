"""Licence scan with ordered signature rules.

A text is reduced to its lower-cased alphanumeric words joined by one space. Every rule of
``license_rules`` (a regular expression over words) has a keyword that all its matches hold; the
words of a whole batch are looked up among the keywords at once, and only the rules of the keywords
a document holds are run over it, over the whole document. Matches are intervals of words. One that
lies within the interval of a surer rule (a lower level; on one level the longer, then the earlier
rule) is suppressed, so "gnu lesser general public license version 3" is one licence and not four.
Places of the base phrases are counted before that, and their labels always stay.

A document is scanned where it is read: nothing is shuffled, and what leaves a task are a few
intervals for each document. Suppression is a sort and a running maximum for each level.

Defined cases: null or empty text has no words and no detection, score 0; each row of documents is
scanned for itself, also where ids repeat or are null; extra columns are not read and clash with
nothing; an empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.frames import bounded_batches
from basketry.llm.license_rules import LEVELS, RULES, WEIGHTS, Rule
from basketry.llm.textual import ALPHANUMERIC, Texts, hashes, lists, lowered, slices, spans, texts_of

DETECTION = "struct<rule:int,kind:string,label:string,base:boolean,first:long,after:long,kept:boolean>"


def joined_words(texts: Texts, start: np.ndarray, end: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of all texts, each followed by a space; where each text and each word begins."""
    size = end - start + 1
    begins = np.concatenate([[0], np.cumsum(size)])
    out = np.full(begins[-1], 0x20, np.uint8)
    inside = np.ones(begins[-1], bool)
    inside[begins[1:] - 1] = False
    member = np.zeros(len(texts.data) + 1, np.int8)
    np.add.at(member, start, 1)
    np.add.at(member, end, -1)
    out[inside] = texts.data[np.cumsum(member[:-1], dtype=np.int8) > 0]
    return out.tobytes(), begins[:-1], begins


class Scanner:
    """Compiled rules and the keywords that open them."""

    def __init__(self, rules: Sequence[Rule] = RULES):
        self.rules = rules
        self.patterns = [re.compile(rb"(?<![^ ])(?:" + r.pattern.encode() + rb")(?![^ ])") for r in rules]
        by_keyword: dict[str, list[int]] = defaultdict(list)
        for k, r in enumerate(rules):
            by_keyword[r.keyword].append(k)
        if "" in by_keyword:
            raise ValueError(f"rules without a keyword: {[rules[k].pattern for k in by_keyword['']]}")
        data = np.frombuffer("".join(by_keyword).encode(), np.uint8)
        size = np.cumsum([0, *(len(w) for w in by_keyword)])
        key = hashes(data, size[:-1], size[1:])
        order = np.argsort(key)
        self.keys, opened = key[order], list(by_keyword.values())
        self.opened = [opened[k] for k in order]
        self.level = np.array([LEVELS[r.kind] for r in rules])

    def opened_rules(self, word: np.ndarray, doc: np.ndarray) -> dict[int, list[int]]:
        """The rules to run over each document, by the keywords among its words."""
        at = np.minimum(np.searchsorted(self.keys, word), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == word)
        found: dict[int, list[int]] = defaultdict(list)
        for pair in np.unique(doc[hit] * len(self.keys) + at[hit]):
            found[int(pair) // len(self.keys)] += self.opened[int(pair) % len(self.keys)]
        return found

    def survivors(self, rule: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Which intervals of a document lie within none of a surer rule."""
        kept = np.ones(len(rule), bool)
        level = self.level[rule]
        order = np.lexsort((rule, level, -hi, lo))
        for at in np.unique(level):
            seen = order[level[order] <= at]
            reach = np.maximum.accumulate(hi[seen])
            due = np.flatnonzero(level[seen] == at)
            due = due[due > 0]
            kept[seen[due[reach[due - 1] >= hi[seen[due]]]]] = False
        return kept

    def scan(self, texts: Texts) -> dict[str, np.ndarray]:
        """Number of words and of detections of each text, and the detections by rule, words, kept."""
        low = lowered(texts)
        start, end, first = spans(low, ALPHANUMERIC)
        n_docs = len(first) - 1
        doc = np.repeat(np.arange(n_docs), np.diff(first))
        opened = self.opened_rules(hashes(low.data, start, end), doc)
        counts, parts = np.zeros(n_docs, np.int64), []
        if opened:
            data, word_at, begins = joined_words(low, start, end)
        for d in sorted(opened):
            own = data[begins[first[d]] : begins[first[d + 1]]]
            found = [(k, m.start(), m.end()) for k in opened[d] for m in self.patterns[k].finditer(own)]
            if not found:
                continue
            rule, lo, hi = np.array(found, np.int64).T
            places = word_at[first[d] : first[d + 1]] - begins[first[d]]
            lo, hi = np.searchsorted(places, lo), np.searchsorted(places, hi)
            order = np.lexsort((rule, hi, lo))
            rule, lo, hi = rule[order], lo[order], hi[order]
            counts[d] = len(rule)
            parts.append((rule, lo, hi, self.survivors(rule, lo, hi)))
        none = np.empty(0, np.int64)
        rule, lo, hi, kept = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (none, none, none, none.astype(bool))
        return {"n_words": np.diff(first), "counts": counts, "rule": rule, "first": lo, "after": hi, "kept": kept}


def detections(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``doc_id, n_words, found`` for each row: every detection as ``[first, after)`` in words, in
    order of place, and whether it was ``kept`` or suppressed by a surer one around it."""
    bounded_batches(docs.sparkSession)
    chosen = list(rules)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen)
        kinds, labels = (pa.array([getattr(r, c) for r in chosen], pa.string()) for c in ("kind", "label"))
        base = pa.array([r.base for r in chosen], pa.bool_())
        for batch in batches:
            for i, j, texts in slices(texts_of(batch.column(1))):
                m = scanner.scan(texts)
                rule = pa.array(m["rule"], pa.int64())
                columns = [rule.cast(pa.int32()), kinds.take(rule), labels.take(rule), base.take(rule), *(pa.array(m[c]) for c in ("first", "after", "kept"))]
                found = lists(pa.StructArray.from_arrays(columns, ["rule", "kind", "label", "base", "first", "after", "kept"]), m["counts"])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(m["n_words"]), found], ["doc_id", "n_words", "found"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(scanned, f"doc_id {kind}, n_words long, found array<{DETECTION}>")


def report(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Counts and places of the base phrases, and the labels that are left."""
    base = F.filter("found", lambda x: x["base"])
    left = F.filter("found", lambda x: x["base"] | x["kept"])

    def text_of(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["label"]))), ",")

    weight = F.create_map(*(F.lit(x) for pair in WEIGHTS.items() for x in pair))
    return detections(docs, rules).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda x: x["first"])).alias("last_word"),
        text_of(base).alias("base_labels"),
        text_of(left).alias("labels"),
        F.coalesce(F.array_max(F.transform(left, lambda x: weight[x["kind"]])), F.lit(0.0)).alias("score"),
    )
