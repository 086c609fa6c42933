"""What the Jaccard join keeps on disk: tables go when read, sets are shuffled in turns."""

import itertools
import os
from collections import Counter

import numpy as np

from basketry.llm import frames, jaccard_join


def docs_of(spark):
    random = np.random.default_rng(5)
    docs = [(None, "no id"), (500, None), (501, "")]
    for g in range(4):
        base = [f"g{g}w{x}" for x in random.integers(0, 400, 80)]
        for i in range(6):
            text = list(base)
            for p in random.integers(0, 80, i % 3):
                text[p] = f"n{random.integers(0, 9)}"
            docs.append((g * 10 + i, " ".join(text)))
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3)


def test_turns_give_the_same_rows(spark, monkeypatch):
    frame = docs_of(spark)
    plain = Counter(map(tuple, jaccard_join.report(frame, percent=80).collect()))
    assert len({c for _, _, c in plain}) < sum(plain.values()) - 10
    asked = []
    monkeypatch.setattr(jaccard_join, "turns_of", lambda size, rows=0: asked.append(size) or 2)
    assert Counter(map(tuple, jaccard_join.report(frame, percent=80).collect())) == plain
    assert any(asked)


def test_turns_are_bounded(monkeypatch):
    monkeypatch.setattr(jaccard_join, "TURN_BYTES", 100)
    assert [jaccard_join.turns_of(x) for x in (0, 100, 101, 10**9)] == [1, 1, 2, jaccard_join.TURNS]
    assert jaccard_join.turns_of(0, 3 * jaccard_join.TURN_ROWS) == 3


def scratch(monkeypatch, folder):
    numbers = itertools.count()
    monkeypatch.setattr(frames, "scratch_dir", lambda spark, label: f"{folder}/{label}-{next(numbers)}")


def test_clean_leaves_no_wide_table(spark, tmp_path, monkeypatch):
    scratch(monkeypatch, tmp_path)
    kept = jaccard_join.clean(docs_of(spark), percent=80)
    assert kept.filter("doc_id < 500").count() == 4
    left = {name.rpartition("-")[0] for name in os.listdir(tmp_path)}
    assert "gone" in left and not left & {"signatures", "nodes", "rows", "grams", "open-groups", "due", "edges"}


def test_a_discarded_frame_is_deleted(spark, tmp_path, monkeypatch):
    scratch(monkeypatch, tmp_path)
    one, two = (frames.stored(spark.range(3), label) for label in ("one", "two"))
    frames.discard(one)
    assert os.listdir(tmp_path) == ["two-1"]
    assert two.count() == 3
