"""Logs of micro-batches: compaction, buckets, replays."""

import random
from datetime import datetime, timedelta

from basketry.sources import files
from basketry.operators.dedup import latest_by_key
from basketry.streaming.log import append, bucket_of, compact_log, read_log, spans, touched

START = datetime(2024, 1, 1)


def test_folders_stay_few_and_rows_stay_right(spark, tmp_path):
    path, truth = str(tmp_path / "log"), {}
    random.seed(2)
    for n in range(28):
        rows = [(random.randrange(9), START + timedelta(minutes=n), random.random()) for _ in range(4)]
        rows = list({r[0]: r for r in rows}.values())
        truth |= {r[0]: r for r in rows}
        compact_log(spark, path, n, ["k"], ["k"], fan_in=3)
        append(spark.createDataFrame(rows, "k int, event_time timestamp, x double"), path, n, ["k"])
        assert len(spans(spark, path)) <= 2 + 2 * 3 + 1  # two of each of three tiers, one more
    assert spans(spark, path)[0] == (0, 26)
    append(spark.createDataFrame(rows, "k int, event_time timestamp, x double"), path, 27, ["k"])
    assert {r.k: tuple(r) for r in latest_by_key(read_log(spark, path), ["k"]).collect()} == truth


def test_a_reader_opens_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([(k, START) for k in range(200)], "k int, event_time timestamp")
    append(rows, path, 0, ["k"])
    wanted = rows.filter("k = 7")
    found = read_log(spark, path, touched(wanted, ["k"]))
    assert 0 < found.count() < 60 and found.filter("k = 7").count() == 1
    assert found.select(bucket_of(["k"])).distinct().count() == 1
    assert read_log(spark, str(tmp_path / "none")) is None


def test_a_compaction_that_died_repeats_no_row(spark, tmp_path):
    path = str(tmp_path / "log")
    for n in range(3):
        append(spark.createDataFrame([(n, START)], "k int, event_time timestamp"), path, n, ["k"])
    compact_log(spark, path, 3, ["k"], ["k"], fan_in=3)
    append(spark.createDataFrame([(1, START)], "k int, event_time timestamp"), path, 1, ["k"])
    assert spans(spark, path) == [(0, 2)]
    assert sorted(r.k for r in read_log(spark, path).collect()) == [0, 1, 2]
    assert "batch_id=0-2" in files.names(spark, path)
