"""A batch of envelopes is read once, whatever entities it has, and stores what marts read."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from basketry.operators.flatten import flatten
from basketry.plans import marts as build
from basketry.sources.envelopes import judge, split_valid
from basketry.streaming.marts import build_batch, read_mart

RUN = datetime(2025, 10, 5, 15, 20, 35)
SENT = "topic string, json_data string, event_time timestamp"
PURCHASE = {
    "purchase_id": "o1", "customer": {"customer_id": "c1"}, "store": {"store_id": "s"}, "total_amount": 1.5,
    "purchase_datetime": "2025-01-01T10:00:00", "items": [{"product_id": "p1", "quantity": 2}, {"product_id": "p2"}],
}
ROWS = [
    ("purchases", json.dumps(PURCHASE)), ("purchases", '{"purchase_id": '), ("purchases", None),
    ("products", '{"id": "p1", "price": 2.5}'), ("products", "[1]"), ("stores", '{"store_id": "s1"}'),
]


def test_every_envelope_is_read_once(spark, tmp_path):
    reads, base = spark.sparkContext.accumulator(0), str(tmp_path)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    sent = spark.createDataFrame([(*r, RUN) for r in ROWS], SENT).coalesce(1)
    build_batch(base)(sent.mapInArrow(count, SENT), 0)
    assert reads.value == len(ROWS)
    assert [r.purchase_id for r in read_mart(spark, base, "fact_purchases").collect()] == ["o1"]
    assert sorted(r.product_id for r in read_mart(spark, base, "fact_purchase_items").collect()) == ["p1", "p2"]
    assert [r.product_id for r in read_mart(spark, base, "dim_products").collect()] == ["p1"]
    assert [r.store_id for r in read_mart(spark, base, "dim_stores").collect()] == ["s1"]
    bad = spark.read.parquet(f"{base}/quarantine").groupBy("topic").count().collect()
    assert sorted(map(tuple, bad)) == [("products", 1), ("purchases", 2)]
    assert spark.read.parquet(f"{base}/quarantine").filter("json_data IS NULL").count() == 1


def test_only_some_envelopes_are_judged(spark):
    sent = spark.createDataFrame([(*r, RUN) for r in ROWS], SENT).coalesce(1)
    own = F.col("topic") == "purchases"
    some = judge(sent, "purchases", own)
    want = judge(sent.filter(own), "purchases")
    assert sorted(map(str, some.filter(own).collect())) == sorted(map(str, want.collect()))
    assert some.filter(~own & F.col("doc").isNull() & F.col("reason").isNull()).count() == 3


def test_marts_read_the_stored_columns_only(spark):
    sent = spark.createDataFrame([(*r, RUN) for r in ROWS], SENT).coalesce(1)
    raw = flatten(split_valid(sent.filter("topic = 'purchases'"), "purchases")[0], "purchases")
    for items in ("all", "first"):
        few = raw.select(*build.purchase_columns(items))
        for make in (build.purchase_rows, lambda rows, items=items: build.fact_purchase_items(rows, items)):
            assert sorted(map(str, make(few).collect())) == sorted(map(str, make(raw).collect()))
        assert make(few).count() == (2 if items == "all" else 1)
