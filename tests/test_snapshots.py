"""Tables in parts: merges, moves between months, unfinished runs, expiry."""

import random
from datetime import datetime, timedelta

import pytest

from basketry.sources import files
from basketry.sources.snapshots import Snapshot, read_snapshot

SHAPE = "k int, d timestamp, event_time timestamp, x double"


def folders(snapshot, name):
    return {p: x["folder"] for p, x in snapshot.parts(name).items()}


def test_merges_match_brute_force_and_touch_only_their_months(spark, tmp_path):
    base, truth = str(tmp_path), {}
    random.seed(1)
    for n in range(4):
        rows, months = [], [random.randrange(1, 13) for _ in range(3)]
        for _ in range(12):
            seen = datetime(2024, 1, 1) + timedelta(hours=1000 * n + random.randrange(900))
            row = (random.randrange(15), datetime(2024, random.choice(months), 5), seen, random.random())
            rows.append(row)
            old = truth.get(row[0])
            if old is None or (row[2], row[1], row[3]) > (old[2], old[1], old[3]):
                truth[row[0]] = row
        before = Snapshot(spark, base)
        old, had = folders(before, "t"), {r.k: r.d.strftime("%Y%m") for r in before.read("t").collect()} if n else {}
        snapshot = Snapshot(spark, base)
        snapshot.merge("t", spark.createDataFrame(rows, SHAPE), ["k"], month_of="d")
        snapshot.commit()
        assert {r.k: tuple(r) for r in read_snapshot(spark, base, "t").collect()} == truth
        touched = {r[1].strftime("%Y%m") for r in rows} | {had[r[0]] for r in rows if r[0] in had}
        new = folders(snapshot, "t")
        assert all(new[p] == f for p, f in old.items() if p not in touched)
        assert sum(new[p] != old.get(p) for p in new) <= len(touched)


def test_a_run_that_dies_leaves_all_tables_as_they_were(spark, tmp_path):
    base = str(tmp_path)
    day = datetime(2024, 1, 1)
    first = Snapshot(spark, base)
    for name in ("a", "b"):
        first.merge(name, spark.createDataFrame([(1, day, day, 1.0)], SHAPE), ["k"])
    first.commit()
    dying = Snapshot(spark, base)
    later = spark.createDataFrame([(1, day, day + timedelta(days=1), 2.0), (2, day, day, 2.0)], SHAPE)
    dying.merge("a", later, ["k"])
    assert dying.read("a").count() == 2
    del dying  # before "b" and before its commit
    for name in ("a", "b"):
        assert [r.x for r in read_snapshot(spark, base, name).collect()] == [1.0]
    again = Snapshot(spark, base)
    for name in ("a", "b"):
        again.merge(name, later, ["k"])
    again.commit()
    again.vacuum(keep=1)
    for name in ("a", "b"):
        assert sorted(r.x for r in read_snapshot(spark, base, name).collect()) == [2.0, 2.0]
        used = {f.split("/")[1] for f in folders(again, name).values()}
        assert set(files.names(spark, f"{base}/{name}")) == used


def test_two_commits_from_one_state_do_not_both_win(spark, tmp_path):
    base, rows = str(tmp_path), spark.createDataFrame([(1, None, datetime(2024, 1, 1), 1.0)], SHAPE)
    one, other = Snapshot(spark, base), Snapshot(spark, base)
    one.merge("a", rows, ["k"])
    other.merge("a", rows, ["k"])
    one.commit()
    with pytest.raises(OSError):
        other.commit()


def test_expiry_drops_whole_months_and_rewrites_the_border_only(spark, tmp_path):
    base = str(tmp_path)
    rows = [(m * 10 + i, datetime(2024, m, 5), datetime(2024, m, 10 + 10 * i), 0.5) for m in range(1, 7) for i in range(2)]
    snapshot = Snapshot(spark, base)
    snapshot.merge("t", spark.createDataFrame(rows, SHAPE), ["k"], month_of="d")
    snapshot.commit()
    old = folders(snapshot, "t")
    later = Snapshot(spark, base)
    later.expire("t", 10, datetime(2024, 3, 25))
    later.commit()
    assert {r.k for r in read_snapshot(spark, base, "t").collect()} == {r[0] for r in rows if r[2] >= datetime(2024, 3, 15)}
    new = folders(later, "t")
    assert set(new) == {f"2024{m:02d}" for m in range(3, 7)}
    assert [p for p in new if new[p] != old[p]] == ["202403"]
