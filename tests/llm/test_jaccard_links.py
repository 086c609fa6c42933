"""Every link counts: the number of links of each row against brute force and SQL."""

import os
from collections import Counter

import numpy as np
import pytest

from basketry.llm import jaccard_join, registered

TABLES = "/root/testdata/sf0.001"


def grams(text, k):
    w = (text or "").lower().split()
    return {tuple(w[p : p + k]) for p in range(max(len(w) - k + 1, 1))} if w else set()


def counts(docs, k, percent):
    sets = [grams(t, k) for _, t in docs]
    near = lambda a, b: a and b and 100 * len(a & b) >= percent * len(a | b)
    return [(i, sum(bool(near(s, o)) for y, o in enumerate(sets) if y != x)) for x, ((i, _), s) in enumerate(zip(docs, sets))]


@pytest.mark.parametrize("pivots,before", [(32, 8), (3, 1)])
def test_every_link_of_near_copies_is_counted(spark, monkeypatch, pivots, before):
    monkeypatch.setattr(jaccard_join, "PIVOTS", pivots)
    monkeypatch.setattr(jaccard_join, "BEFORE", before)
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    random = np.random.default_rng(11)
    docs, base = [(None, ""), (900, None), (901, "two words"), (902, "Two words")], [f"w{x}" for x in random.integers(0, 500, 100)]
    for i in range(60):
        text = list(base)
        for p in random.integers(0, 100, random.integers(0, 5)):
            text[p] = f"n{random.integers(0, 6)}"
        docs += [(i, " ".join(text))] * (1 + (i % 20 == 0))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = jaccard_join.report_links(frame, percent=80, order_size=16).collect()
    expected = counts(docs, 3, 80)
    assert len({n for _, n in expected}) > 5
    assert Counter((r["doc_id"], r["n_links"]) for r in got) == Counter(expected)
    plain = jaccard_join.report(frame, percent=80, order_size=16).collect()
    assert Counter(map(tuple, plain)) == Counter(tuple(r)[:3] for r in got)


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no given tables")
def test_links_agree_with_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{TABLES}/documents.parquet'")
    df = registered.op10_jaccard_links(spark, TABLES)
    expected = con.execute(registered.oracles()["op10_jaccard_links"])
    assert df.columns == [d[0] for d in expected.description]
    assert Counter(map(tuple, df.collect())) == Counter(expected.fetchall())
