"""Rows behind the watermark get a table of their own."""

from datetime import datetime, timedelta

from basketry.streaming.late import dedup_batch, dedup_with_late
from basketry.streaming.raw import run_available

START = datetime(2024, 1, 1, 12)
SHAPE = "k int, event_time timestamp, x string"


def at(minutes):
    return START + timedelta(minutes=minutes)


def found(spark, base, name):
    rows = spark.read.schema(SHAPE).parquet(f"{base}/{name}").collect()
    return sorted((r.k, r.x) for r in rows)


def test_a_late_row_lands_in_its_own_table(spark, tmp_path):
    base, source = str(tmp_path / "t"), str(tmp_path / "in")
    spark.createDataFrame([(1, at(0), "a"), (1, at(1), "b"), (2, at(60), "c")], SHAPE).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(SHAPE).parquet(source)
    run_available(dedup_with_late(stream, ["k"], "30 minutes", base, f"{tmp_path}/c"))
    assert (found(spark, base, "out"), found(spark, base, "late")) == ([(1, "a"), (2, "c")], [])
    later = [(3, at(10), "too late"), (2, at(50), "again"), (4, at(40), "in time"), (5, None, "no time"), (None, at(70), "n")]
    spark.createDataFrame(later, SHAPE).coalesce(1).write.mode("append").parquet(source)
    run_available(dedup_with_late(stream, ["k"], "30 minutes", base, f"{tmp_path}/c"))
    assert found(spark, base, "late") == [(3, "too late"), (5, "no time")]
    kept = spark.read.schema(SHAPE).parquet(f"{base}/out").collect()
    assert {(r.k, r.x) for r in kept} == {(1, "a"), (2, "c"), (4, "in time"), (None, "n")}


def test_replays_change_nothing_and_old_keys_expire(spark, tmp_path):
    base = str(tmp_path / "t")
    step = dedup_batch(base, ["k"], "10 minutes")
    for n in range(12):
        rows = spark.createDataFrame([(n % 5, at(5 * n), str(n)), (n % 5, at(5 * n), str(n))], SHAPE)
        for _ in range(2 if n % 4 == 3 else 1):
            step(rows, n)
    # A key comes again after 25 minutes, behind the delay: its state is gone, so it is new.
    assert found(spark, base, "out") == sorted((n % 5, str(n)) for n in range(12))
    assert found(spark, base, "late") == []
