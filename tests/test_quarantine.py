"""What the daily run cannot read is kept with its raw text."""

import json

import pytest
from test_daily import START, customer, product, purchase, store

from basketry.plans.daily import ingest, publish


def quarantined(spark, out):
    rows = spark.read.parquet(f"{out}/quarantine").collect()
    return sorted((r["topic"], r["reason"].split(":")[0], r["json_data"]) for r in rows)


def test_broken_documents_reach_the_quarantine(spark, tmp_path):
    base, out = tmp_path / "documents", str(tmp_path / "out")
    good = {"products": product("p1"), "stores": store("s1"), "customers": customer("c1"), "purchases": purchase("o1", START)}
    for entity, doc in good.items():
        (base / entity).mkdir(parents=True)
        (base / entity / "good.json").write_text(json.dumps(doc))
    (base / "products" / "bad.json").write_text('{"id": "p2", "name"')
    for _ in range(2):  # a retry keeps it once
        publish(spark, str(base), f"{out}/envelopes", START)
        ingest(spark, f"{out}/envelopes", out, START, str(base))
    assert quarantined(spark, out) == [("products", "unreadable document", '{"id": "p2", "name"')]
    assert [r["id"] for r in spark.read.parquet(f"{out}/raw/products").select("id").collect()] == ["p1"]


@pytest.mark.parametrize("foldered", [False, True])
def test_bad_lines_and_unknown_topics_reach_the_quarantine(spark, tmp_path, foldered):
    source, out = tmp_path / "envelopes", str(tmp_path / "out")
    folder = source / "topic=products" if foldered else source
    folder.mkdir(parents=True)
    body = json.dumps({"id": "p1"})
    lines = [json.dumps({"topic": t, "json_data": body, "event_time": "2025-01-10T07:00:00"}) for t in ("products", "gadgets", None)]
    (folder / "a.json").write_text("\n".join([lines[0], "not json"] + ([] if foldered else lines[1:])))
    if foldered:
        (source / "topic=gadgets").mkdir()
        (source / "topic=gadgets" / "b.json").write_text(lines[1])
    ingest(spark, str(source), out, START)
    expected = (
        [("products", "unparseable json_data", "not json"), ("unrouted", "unknown topic", body)] if foldered
        else [("unrouted", "missing topic", "not json"), ("unrouted", "missing topic", body), ("unrouted", "unknown topic", body)]
    )
    assert quarantined(spark, out) == sorted(expected)
    assert spark.read.parquet(f"{out}/raw/products").count() == 1
