"""Streams over large inputs: sent slice by slice, waiting rows and logs looked through share by share."""

import glob
import json
from datetime import datetime, timedelta

import pytest
from support import TABLES, needs_tables

from basketry.operators.dedup import latest_by_key
from basketry.queries import registry, retail, streams
from basketry.streaming import log, marts
from basketry.streaming.marts import build_batch, read_mart, settle

RUN = datetime(2025, 10, 5, 15, 20, 35)
SENT = "topic string, json_data string, event_time timestamp"
HOMES = 12


def rows(df):
    return sorted(map(str, df.collect()))


def home(i):
    return {"country": "a", "city": "b", "street": f"s{i}", "house": "1", "apartment": "2", "postal_code": f"{i:06d}"}


def purchases(spark):
    docs = [
        {"purchase_id": f"o{i}", "customer": {"customer_id": f"c{i}"}, "store": {"store_id": "s"}, "total_amount": 1.5,
         "purchase_datetime": "2025-01-01T10:00:00", "delivery_address": home(i)} for i in range(HOMES + 1)
    ]
    return spark.createDataFrame([("purchases", json.dumps(d), RUN) for d in docs], SENT).coalesce(1)


def customers(spark):
    docs = [{"customer_id": f"c{i}", "delivery_address": home(i)} for i in range(HOMES)]
    return spark.createDataFrame([("customers", json.dumps(d), RUN) for d in docs], SENT).coalesce(1)


@needs_tables
def test_slices_hold_every_document_once(spark):
    t = registry.Source(spark, TABLES)
    for entity in ("stores", "purchases"):
        parts = retail.slices(t, entity, 3, 4)
        assert len(parts) == 4
        docs = [rows(retail.envelopes(p, entity)) for p in parts]
        assert all(docs) and sorted(sum(docs, [])) == rows(retail.envelopes(t, entity))
        assert retail.slices(t, entity, 10**9, 4) == [t]


@needs_tables
def test_a_slice_is_sent_when_the_one_before_is_consumed(spark, monkeypatch):
    seen = []

    def write(envelopes, path):
        seen.append(len(glob.glob(f"{path}/../checkpoint/commits/[0-9]*")))
        return sent(envelopes, path)

    sent = streams.write_envelopes
    t = registry.Source(spark, TABLES)
    monkeypatch.setattr(streams, "write_envelopes", write)
    monkeypatch.setattr(streams, "SLICE_ROWS", t.lineitem.count() // 2 + 1)
    monkeypatch.setattr(log, "SHARE_BYTES", 1)
    late = registry.queries()["stream_marts_late"](spark, TABLES)
    assert seen == [0, 1, 2, 2, 2]
    assert rows(late) == rows(registry.queries()["mart_fact_purchases"](spark, TABLES).select(late.columns))


@pytest.mark.parametrize("replayed", [False, True])
def test_waiting_purchases_are_called_by_shares(spark, tmp_path, monkeypatch, replayed):
    base, calls = str(tmp_path), []

    def append(df, path, batch_id, by, more=False):
        calls.extend([path] * more)
        log.append(df, path, batch_id, by, more)

    monkeypatch.setattr(log, "SHARE_BYTES", 1)
    monkeypatch.setattr(marts, "append", append)
    build_batch(base)(purchases(spark), 0)
    for _ in range(2 if replayed else 1):
        calls.clear()
        build_batch(base)(customers(spark), 1)
    assert 1 < len(calls) <= HOMES and set(calls) == {f"{base}/fact_purchases"}
    facts = read_mart(spark, base, "fact_purchases")
    assert facts.filter("delivery_address_id IS NULL").count() == 1
    assert facts.count() == HOMES + 1
    assert log.read_log(spark, f"{base}/fact_purchases").count() == 2 * HOMES + 1
    assert rows(settle(spark, base, "fact_purchases", f"{base}/plain")) == rows(facts)


def test_shares_and_compaction_by_shares(spark, tmp_path, monkeypatch):
    path, reads = str(tmp_path / "log"), []
    shape = "k int, event_time timestamp, x int"
    for n in range(3):
        made = [(k, RUN + timedelta(minutes=n), n) for k in range(n, 60)]
        log.append(spark.createDataFrame(made, shape), path, n, ["k"])
    assert log.shares(spark, path) == [list(range(log.BUCKETS))]
    assert log.shares(spark, path, [3, 5]) == [[3, 5]]
    assert log.shares(spark, str(tmp_path / "none")) == [[]]
    want = rows(latest_by_key(log.read_log(spark, path), ["k"]))
    monkeypatch.setattr(log, "SHARE_BYTES", 1)
    assert log.shares(spark, path) == [[b] for b in range(log.BUCKETS)]
    read = log.read_log
    monkeypatch.setattr(log, "read_log", lambda *a, **k: reads.append(a) or read(*a, **k))
    log.compact_log(spark, path, 3, ["k"], ["k"], fan_in=3)
    assert len(reads) == log.BUCKETS and log.spans(spark, path) == [(0, 2)]
    assert rows(read(spark, path)) == want
