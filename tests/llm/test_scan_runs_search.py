"""Licence scan, periodic runs and ranked search on awkward rows against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import lexical_search, license_rules, license_scan, periodic_runs
from basketry.llm.textual import mixed, texts_of

TOKEN = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def lower(x):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in x or "")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


LICENCES = [
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file\n# except in compliance",
    "GNU Lesser General Public License version 3, and the GNU General Public License v2.0 or later",
    "mit license MIT\n * License; CC-BY CC BY-NC 4.0 cc by",
    "SPDX-License-Identifier: GPL-2.0-only all rights reserved https://www.gnu.org/licenses/gpl-2.0.html",
    "permit license, amit license, miss licenses café-mit license émit license",
    "cc by " * 400,
    "",
    None,
]


def scanned(text):
    """Every rule over every text, and each pair of detections."""
    words = TOKEN.findall(lower(text))
    joined = " ".join(words)
    found = []
    for r in license_rules.RULES:
        for m in re.finditer(f"(?<![^ ])(?:{r.pattern})(?![^ ])", joined):
            found.append((len(joined[: m.start()].split()), len(joined[: m.end()].split()), license_rules.LEVELS[r.kind], r.number, r))

    def surer(o, x):
        inside = o[0] <= x[0] and o[1] >= x[1]
        return inside and (o[2], x[0] - o[0] + x[1] - o[1] == 0 and o[3]) != (x[2], x[0] - o[0] + x[1] - o[1] == 0 and x[3]) and (
            o[2] < x[2] or o[2] == x[2] and (o[1] - o[0] > x[1] - x[0] or o[1] - o[0] == x[1] - x[0] and o[3] < x[3])
        )

    base = [x for x in found if x[4].base]
    left = [x for x in found if x[4].base or not any(surer(o, x) for o in found)]
    starts = [x[0] for x in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({x[4].label for x in base})),
        ",".join(sorted({x[4].label for x in left})), max((license_rules.WEIGHTS[x[4].kind] for x in left), default=0.0),
    )


def test_base_phrases_are_rules():
    assert {r.label: r.pattern for r in license_rules.RULES if r.base} == license_rules.BASE
    assert all(r.keyword for r in license_rules.RULES)
    assert sum(r.kind != "tag" for r in license_rules.RULES) >= 300


def test_license_scan(spark, awkward):
    texts = [*LICENCES, *(r["text"] for r in awkward.collect())]
    docs = spark.createDataFrame([(k, t, "x", k) for k, t in enumerate(texts)], "doc_id long, text string, label string, found int")
    assert plain(license_scan.report(docs)) == sorted(((k, *scanned(t)) for k, t in enumerate(texts)), key=str)


def test_a_rule_needs_its_keyword():
    """Without the gate every rule finds the same in texts made of the rules' own words."""
    pool = sorted({w for r in license_rules.RULES for w in re.findall("[0-9a-z]+", r.pattern)})
    random.seed(3)
    texts = [" ".join(random.choice(pool) for _ in range(30)) for _ in range(20)]
    texts += [re.sub(r"\([^()]*\)|[^0-9a-z ]", "", r.pattern) for r in license_rules.RULES]
    scanner = license_scan.Scanner()
    found = scanner.scan(texts_of(pa.array(texts)))
    assert found["counts"].tolist() == [sum(len(list(p.finditer(" ".join(TOKEN.findall(t)).encode()))) for p in scanner.patterns) for t in texts]


def test_many_detections_in_a_long_text():
    found = license_scan.Scanner().scan(texts_of(pa.array(["the mit license and " * 50_000])))
    assert found["counts"].tolist() == [50_000] and found["kept"].all()


def runs_of(x):
    found = {}
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i + q < len(x):
            if x[i] != x[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(x) and x[i] == x[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                found.setdefault((start, i - start + q), q)
    return sorted((start, q, size) for (start, size), q in found.items())


def planted(doc_id, text):
    w = WORD.findall(text or "")
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def digest(doc_id, text):
    w = planted(doc_id, text)
    runs = runs_of(w)
    lost = {i for s, q, size in runs for i in range(s + q, s + size)}
    s, q, size = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=(None, None, None))
    listed = "".join(f"{s},{size},{q}\n" for s, q, size in runs)
    return doc_id, len(runs), s, size, q, size and 1000 * size // q, sha(listed), sha(" ".join(x for i, x in enumerate(w) if i not in lost))


def stitched(codes, tile):
    found = []
    for b in periodic_runs.octaves(len(codes)):
        for lo, hi in periodic_runs.tiles(len(codes), b, tile):
            period, x, y = periodic_runs.fragments(periodic_runs.Sequence(codes[lo:hi]), b, hi - lo, hi - lo < len(codes))
            found += zip(period.tolist(), (x + lo).tolist(), (y + lo).tolist(), strict=True)
    runs = []
    for q, lo, hi in sorted(found):
        if runs and runs[-1][0] == q and lo <= runs[-1][2]:
            runs[-1][2] = max(runs[-1][2], hi)
        else:
            runs.append([q, lo, hi])
    return sorted((lo, q, hi - lo + q) for q, lo, hi in runs if hi - lo + q >= max(6, 4 * q))


def test_tiles_of_any_size_give_the_same_runs():
    random.seed(1)
    for _ in range(400):
        n, k = random.randint(0, 160), random.choice([1, 2, 2, 3, 5])
        x = [random.randrange(k) for _ in range(n)]
        for _ in range(random.randint(0, 3) if n else 0):
            a = random.randrange(n)
            p, e = random.randint(1, max(1, (n - a) // 3)), random.randint(a, n)
            x[a:e] = [x[a + (i - a) % p] for i in range(a, e)]
        codes = mixed(np.array(x, np.uint64) + np.uint64(77))
        whole = periodic_runs.solve_whole(codes, np.array([0, n]), np.array([0])).get(0, [])
        assert sorted((lo, q, hi - lo + q) for q, lo, hi in whole) == runs_of(x)
        for tile in (1, 24):
            assert stitched(codes, tile) == runs_of(x)


@pytest.mark.parametrize("tile", [40, 1 << 16])
def test_periodic_runs(spark, awkward, tile):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect() if len(r["text"] or "") < 5000]
    random.seed(5)
    for k in range(60):
        n = random.randint(0, 150)
        rows.append((100 + k, " ".join(random.choice(["a", "b", "é"]) for _ in range(n)) + random.choice(["", "\n\tx y " * 9])))
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, runs string, row int").repartition(3)
    assert plain(periodic_runs.report(docs, tile)) == sorted((digest(*r) for r in rows), key=str)


def test_one_very_long_run(spark):
    docs = spark.createDataFrame([(3, "same " * 300_000)], "doc_id long, text string")
    found = periodic_runs.find_runs(docs).first()
    assert [tuple(r) for r in found["runs"]] == [(0, 1, 300_000)] and found["kept"] == b"same"


def best(docs, items, k):
    bags = [(i, Counter(TOKEN.findall(lower(t)))) for i, t in docs]
    bags = [b for b in bags if b[1]]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    queries = {}
    for item, text in items:
        if item is not None:
            queries.setdefault(item, Counter()).update(TOKEN.findall(lower(text)))
    found = []
    for item, q in queries.items():
        scores = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // total
            score = sum(x * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m)) for t, x in q.items() if t in b)
            if score > 0:
                scores.append((-score, i is None, i))
        scores.sort(key=lambda s: s[:2] + (() if s[1] else s[2:]))
        found += [(item, r + 1, s[2], -s[0]) for r, s in enumerate(scores[:k])]
    return sorted(found, key=str)


@pytest.mark.parametrize("piece,chars", [(1 << 17, 1 << 22), (40, 60)])
def test_lexical_search(spark, awkward, monkeypatch, piece, chars):
    monkeypatch.setattr(lexical_search, "PIECE_TERMS", piece)
    random.seed(9)
    pool = [f"Term{k}" for k in range(30)] + ["ÉTÉ", "café"]
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    docs += [(200 + k, " ".join(random.choices(pool, k=random.choice([1, 3, 20])))) for k in range(80)]
    docs += [(400 + k, "term1 term2, term1") for k in range(30)]
    items = [(k, " ".join(random.choices(pool, k=5))) for k in range(6)]
    items += [(0, "term1"), (7, None), (None, "term1"), (8, "..."), (9, "nowhere"), (10, "Same, words two term2 word7")]
    table = spark.createDataFrame([(*d, 1, "x", 2) for d in docs], "doc_id long, text string, n int, m string, piece int").repartition(3)
    asked = spark.createDataFrame([(*i, 0.5) for i in items], "item_id long, text string, score double")
    for k in (20, 3):
        assert plain(lexical_search.search(table, asked, k, chars)) == best(docs, items, k)


def test_empty_tables_have_empty_results(spark, nothing):
    asked = spark.createDataFrame([(1, "two words")], "item_id long, text string")
    some = spark.createDataFrame([(1, "two words")], "doc_id long, text string")
    assert license_scan.report(nothing).collect() == []
    assert periodic_runs.report(nothing).collect() == []
    assert lexical_search.search(nothing, asked).collect() == []
    assert lexical_search.search(some, asked.limit(0)).collect() == []
    assert len(lexical_search.search(some, asked).collect()) == 1
