"""Operators against small fixtures and brute force."""

import hashlib
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from basketry.operators.dedup import distinct_labels, latest_by_key, union_sources, upsert_latest
from basketry.operators.flatten import explode_items, flatten
from basketry.operators.lookup import lookup, plausible_dates, require, split_valid_rows
from basketry.operators.masking import mask_nested, mask_topic
from basketry.operators.quality import duplicate_alerts, duplicate_report, profile, table_counts
from basketry.operators.retention import retain
from basketry.sources.envelopes import split_valid, to_envelope
from basketry.sources.tables import unqualify

T0 = datetime(2024, 1, 1)


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_latest_by_key_matches_brute_force_with_a_hot_key(spark):
    rng = random.Random(7)
    data = [
        ("hot" if rng.random() < 0.4 else f"k{rng.randrange(50)}", rng.randrange(20), rng.randrange(9))
        for _ in range(3000)
    ]
    df = spark.createDataFrame(data, "k string, event_time int, v int")
    best = {}
    for k, t, v in data:
        best[k] = max(best.get(k, (-1, -1)), (t, v))
    assert rows(latest_by_key(df, ["k"])) == sorted(((k, *tv) for k, tv in best.items()), key=repr)


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 2)], "k string, event_time int")
    assert rows(distinct_labels(df, "k")) == [("a", 2), (None, 3)]


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 5, "y")], "k string, event_time int, v string")
    batch = spark.createDataFrame([("a", 2, "z"), ("b", 4, "w"), ("c", 1, "n")], old.schema)
    once = upsert_latest(old, batch, ["k"])
    assert rows(once) == [("a", 2, "z"), ("b", 5, "y"), ("c", 1, "n")]
    assert rows(upsert_latest(once, batch, ["k"])) == rows(once)
    assert rows(upsert_latest(None, batch, ["k"])) == rows(batch)
    assert union_sources(old, batch).count() == 5


def test_lookup_null_handling_and_no_fan_out(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "q")], "i int, k string")
    right = spark.createDataFrame([("a", 1), ("a", 2), (None, 9)], "rk string, v int")
    strict = lookup(left, right, [(F.col("k"), "rk")], {"v": "got"}, unique=False, prefer=[F.col("v")])
    assert rows(strict) == [(1, "a", 2), (2, None, None), (3, "q", None)]
    safe = lookup(
        left, right, [(F.col("k"), "rk")], {"v": "got"}, null_safe=True, unique=False,
        prefer=[-F.col("v")],
    )
    assert rows(safe) == [(1, "a", 1), (2, None, 9), (3, "q", None)]
    plan = safe._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_required_valid_and_plausible(spark):
    df = spark.createDataFrame([("a", "x"), (" ", "y"), (None, "z")], "k string, v string")
    assert rows(require(df, "k")) == [("a", "x")]
    good, bad = split_valid_rows(df.withColumn("n", F.lit(None).cast("int")), ["k", "n"])
    assert good.count() == 0 and sorted(r.reason for r in bad.collect()) == ["k,n", "n", "n"]
    people = spark.createDataFrame(
        [(T0.date(), T0 + timedelta(1)), (T0.date(), T0), (None, T0)], "b date, r timestamp"
    )
    assert plausible_dates(people, "b", "r").count() == 1


def test_mask_nested_any_depth(spark):
    df = spark.createDataFrame(
        [("8 900", {"Email": " A@B.C ", "n": 1}, [{"home_phone": "8 1", "note": "8 2"}], None)],
        "phone_email string, web struct<Email: string, n: int>, "
        "lines array<struct<home_phone: string, note: string>>, "
        "gone struct<email: string>",
    )
    got = mask_nested(df).first()
    # The first pattern wins for a name holding both.
    assert got.phone_email == md5("+7900")
    assert got.web.Email == md5("a@b.c") and got.web.n == 1
    assert got.lines[0].note == "8 2" and got.lines[0].home_phone == md5("+71")
    assert got.gone is None
    assert mask_topic(df, "products").first() == df.first()


def envelope(spark, *texts):
    return spark.createDataFrame([(t, T0) for t in texts], "json_data string, event_time timestamp")


def test_reject_split(spark):
    sent = envelope(spark, '{"id": "p1", "price": 3}', '{"id": ', "", None, "{}", "{'id': 'q'}",
                    '{"id": "p2", "kbju": 5}')
    good, bad = split_valid(sent, "products")
    assert sorted(str(r.doc.id) for r in good.collect()) == ["None", "p1", "p2"]
    assert sorted(r.reason for r in bad.collect()) == ["missing json_data"] * 2 + [
        "unparseable json_data"
    ] * 2


def test_parse_happens_once_per_row(spark):
    good, _ = split_valid(envelope(spark, '{"id": "p1"}'), "products")
    plan = flatten(good, "products").filter("id is not null")
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_flatten_modes(spark):
    purchase = """{"purchase_id": "o1", "total_amount": 10.50, "is_delivery": true,
        "customer": {"customer_id": "c1"}, "delivery_address": null,
        "items": [{"product_id": "a", "kbju": {"fat": 2.0}}, {"product_id": "b"}]}"""
    empty = '{"purchase_id": "o2", "items": []}'
    sent = envelope(spark, purchase, empty)
    raw = {r.purchase_id: r for r in flatten(sent, "purchases", missing="").collect()}
    assert raw["o1"].total_amount == "10.5" and raw["o1"].is_delivery == "true"
    assert raw["o1"].items_product_id == "a" and raw["o1"].items_kbju_fat == "2.0"
    assert raw["o1"].delivery_address_city == "" and raw["o2"].items_product_id == ""
    assert raw["o1"].json_data == purchase
    kept = flatten(sent, "purchases")
    assert [r.product_id for r in explode_items(kept, keep=("purchase_id",)).collect()] == ["a", "b"]
    first = flatten(sent, "purchases", items="first", keep_json=False)
    assert "items" not in first.columns and len(first.columns) == 44
    sizes = {e: len(flatten(sent, e, items="first").columns) - 2
             for e in ("stores", "products", "customers")}
    assert sizes == {"stores": 23, "products": 18, "customers": 26}


def test_store_labels_are_joined(spark):
    raw = flatten(envelope(spark, '{"store_id": "s", "categories": ["🥖 A", "B"]}'), "stores")
    assert raw.first().categories == "🥖 A, B"


def test_envelope_carries_one_time(spark):
    docs = spark.createDataFrame([("a", 1.5), ("б", None)], "id string, price double")
    sent = to_envelope(docs, "products", T0).collect()
    assert {r.event_time for r in sent} == {T0} and {r.topic for r in sent} == {"products"}
    assert sent[1].json_data == '{"id":"б"}'


def test_duplicate_report_and_alerts(spark):
    day = [("a",), ("a",), ("a",), ("b",)]
    once = spark.createDataFrame(day, "k string").withColumn("event_time", F.lit(T0))
    older = once.withColumn("event_time", F.lit(T0 - timedelta(1)))
    thrice = union_sources(*[once.filter("k = 'b'")] * 3)
    raw = {"x": (union_sources(once, older), "k"), "y": (thrice, "k"), "z": (older, "k")}
    report = duplicate_report(raw, T0 + timedelta(hours=5))
    assert tuple(report.first()) == (T0, 50, 67, 0)
    assert [r.entity for r in duplicate_alerts(report).collect()] == ["duplicate_y"]
    assert table_counts({"a": once, "b": thrice}).collect()[1].row_count == 3
    total, first = profile(once)
    assert total.first().row_count == 4 and first.count() == 3


def test_retention_and_names(spark):
    df = spark.createDataFrame([(T0,), (T0 - timedelta(10),)], "event_time timestamp")
    assert retain(df, "event_time", 9, T0).count() == 1
    pruned = retain(df.withColumn("ym", F.date_format("event_time", "yyyyMM")), "event_time", 400, T0, "ym")
    assert pruned.count() == 2
    assert unqualify(spark.range(1).toDF("cu.customer_id")).columns == ["customer_id"]
