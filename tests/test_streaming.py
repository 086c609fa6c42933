"""Streams: same marts as the batch run, replays change nothing."""

from datetime import datetime

import pytest
from support import DOCUMENTS, needs_documents

from basketry.operators.masking import mask_topic
from basketry.plans.daily import publish, read_marts
from basketry.schemas import MART_KEYS
from basketry.sources.documents import read_entity
from basketry.sources.envelopes import read_envelopes, to_envelope, write_envelopes
from basketry.streaming.marts import build_batch, compact, read_mart, stream_marts
from basketry.streaming.raw import dedup_stream, run_available, stream_quarantine, stream_raw

RUN = datetime(2025, 10, 5, 15, 20, 35)


def comparable(df):
    cols = sorted(c for c in df.columns if c not in ("event_time", "ym"))
    return sorted(tuple(str(r[c]) for c in cols) for r in df.collect())


@needs_documents
def test_stream_equals_batch_and_replay_changes_nothing(spark, full_run, tmp_path):
    base = str(tmp_path)
    for entity in ("products", "stores", "customers"):
        docs = mask_topic(read_entity(spark, f"{DOCUMENTS}/{entity}", entity), entity)
        write_envelopes(to_envelope(docs.coalesce(1), entity, RUN), f"{base}/in")
    sent = read_envelopes(spark, f"{base}/in", streaming=True)
    assert run_available(stream_marts(sent, f"{base}/marts", f"{base}/checkpoint"))
    docs = mask_topic(read_entity(spark, f"{DOCUMENTS}/purchases", "purchases"), "purchases")
    write_envelopes(to_envelope(docs.coalesce(1), "purchases", RUN), f"{base}/in")
    run_available(stream_marts(sent, f"{base}/marts", f"{base}/checkpoint"))

    def check():
        for table in MART_KEYS:
            want = read_marts(spark, full_run[0])[table]
            assert comparable(read_mart(spark, f"{base}/marts", table)) == comparable(want), table

    check()
    batch = read_envelopes(spark, f"{base}/in").filter("topic = 'purchases'")
    build_batch(f"{base}/marts")(batch, 1)
    check()
    kept = compact(spark, f"{base}/marts", "fact_purchases", f"{base}/plain", as_of=RUN)
    assert kept.count() == 200


def test_raw_stream_and_quarantine(spark, tmp_path):
    base = str(tmp_path)
    texts = ['{"id": "p1"}', '{"id": ', None]
    sent = spark.createDataFrame([("products", t, RUN) for t in texts],
                                 "topic string, json_data string, event_time timestamp")
    write_envelopes(sent, f"{base}/in")
    stream = read_envelopes(spark, f"{base}/in", streaming=True, max_files=1)
    for _ in range(2):
        run_available(stream_raw(stream, "products", f"{base}/raw", f"{base}/c1"))
        run_available(stream_quarantine(stream, "products", f"{base}/bad", f"{base}/c2"), 120)
    assert [(r.id, r.ym) for r in spark.read.parquet(f"{base}/raw").collect()] == [("p1", 202510)]
    assert spark.read.parquet(f"{base}/bad").count() == 2


def test_missing_event_time_becomes_run_time(spark, tmp_path):
    path = f"{tmp_path}/in"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"topic": "products", "json_data": "{}"}\n')
    assert read_envelopes(spark, path, run_time=RUN).first().event_time == RUN


def test_stream_dedup(spark, tmp_path):
    base = str(tmp_path)
    sent = spark.createDataFrame([(i % 3, RUN) for i in range(9)], "k int, event_time timestamp")
    sent.write.parquet(f"{base}/in")
    once = dedup_stream(spark.readStream.schema(sent.schema).parquet(f"{base}/in"), ["k"], "1 hour")
    query = (
        once.writeStream.format("parquet").option("checkpointLocation", f"{base}/c")
        .trigger(availableNow=True).start(f"{base}/out")
    )
    run_available(query)
    assert spark.read.schema(sent.schema).parquet(f"{base}/out").count() == 3


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_envelopes(spark, "", brokers="localhost:1")


@needs_documents
def test_publish_appends_all_topics(spark, tmp_path):
    publish(spark, DOCUMENTS, f"{tmp_path}/in", RUN)
    counts = read_envelopes(spark, f"{tmp_path}/in").groupBy("topic").count().collect()
    assert {r.topic: r["count"] for r in counts} == {
        "products": 20, "stores": 45, "customers": 45, "purchases": 200,
    }
