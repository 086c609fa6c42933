"""Streams take on a bounded share of what waits, and leave nothing behind that is used up."""

import glob
from datetime import datetime

import pytest

from basketry.sources import envelopes
from basketry.sources.envelopes import judge, read_envelopes, split_valid, write_envelopes
from basketry.streaming.marts import build_batch, read_mart
from basketry.streaming.raw import run_available, stream_raw

RUN = datetime(2025, 10, 5, 15, 20, 35)
SENT = "topic string, json_data string, event_time timestamp"
TEXTS = ['{"id": "p1", "price": 2.5}', '{"id": "p2", "kbju": "x"}', '{"kbju": "x"}', '{"id": ', "[1]", "{}", "", None]


def sent(spark, *texts, topic="products"):
    return spark.createDataFrame([(topic, t, RUN) for t in texts], SENT).coalesce(1)


def test_packed_files_of_few_lines_are_consumed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(envelopes, "LINES_PER_FILE", 1)
    base = str(tmp_path)
    write_envelopes(sent(spark, '{"id": "p1"}', '{"id": "p2"}', '{"id": "p3"}'), f"{base}/in")
    files = f"{base}/in/topic=products/*.json*"
    assert len(glob.glob(files)) == len(glob.glob(files.replace(".json*", ".json.gz"))) == 3
    stream = read_envelopes(spark, f"{base}/in", streaming=True, max_bytes=1, consume=True)
    run_available(stream_raw(stream, "products", f"{base}/raw", f"{base}/c"))
    assert sorted(r.id for r in spark.read.parquet(f"{base}/raw").collect()) == ["p1", "p2", "p3"]
    assert len(glob.glob(f"{base}/c/commits/[0-9]*")) == 3
    assert len(glob.glob(files)) < 3


def test_judge_agrees_with_split_valid(spark):
    batch = sent(spark, *TEXTS)
    good, bad = split_valid(batch, "products")
    both = judge(batch, "products")

    def rows(df):
        return sorted(map(str, df.collect()))

    assert rows(both.filter("reason IS NULL").drop("reason")) == rows(good)
    assert rows(both.filter("reason IS NOT NULL").select(bad.columns)) == rows(bad)
    assert both.count() == len(TEXTS) and bad.count() > 3


@pytest.mark.parametrize("replayed", [False, True])
def test_marts_without_rows_in_a_batch_are_left_alone(spark, tmp_path, replayed):
    base = str(tmp_path)
    store = '{"store_id": "s1", "location": {"country": "a", "city": "b"}}'
    build_batch(base)(sent(spark, store, topic="stores"), 0)
    if replayed:
        build_batch(base)(sent(spark, store, topic="stores"), 1)
    build_batch(base)(sent(spark, *TEXTS), 1)
    assert not glob.glob(f"{base}/dim_stores/batch_id=1") and not glob.glob(f"{base}/addresses/batch_id=1")
    assert glob.glob(f"{base}/dim_products/batch_id=1/*")
    assert [r.store_id for r in read_mart(spark, base, "dim_stores").collect()] == ["s1"]
    assert [r.product_id for r in read_mart(spark, base, "dim_products").collect()] == ["p1"]
    quarantined = spark.read.parquet(f"{base}/quarantine/topic=products/batch_id=1")
    assert quarantined.count() == split_valid(sent(spark, *TEXTS), "products")[1].count()
