"""Purchases from the parts of a document they need, each value computed once."""

import re
from datetime import datetime

import pytest

from basketry.operators.dedup import latest_by_key
from basketry.operators.flatten import flatten
from basketry.operators.lookup import split_valid_rows
from basketry.plans import marts as build
from basketry.schemas import MART_KEYS, only, text_schema
from basketry.sources.envelopes import split_valid

RUN = datetime(2025, 10, 5, 15, 20, 35)
HEAD = '"customer": {"customer_id": "C1"}, "store": {"store_id": "S1"}, "purchase_datetime": "2025-01-02"'
TEXTS = [
    f'{{"purchase_id": "A", "total_amount": 1.259, {HEAD}, "items": [{{"product_id": "x"}}]}}',
    f'{{"purchase_id": "A", "total_amount": 3, {HEAD}, "items": "odd"}}',
    f'{{"purchase_id": "A", "total_amount": "none", {HEAD}, "items": []}}',
    f'{{"purchase_id": "B", {HEAD}, "delivery_address": {{"city": " Oslo "}}}}',
    f'{{"purchase_id": "C", "total_amount": 2, {HEAD}, "delivery_address": {{"city": " Oslo "}}}}',
    '{"purchase_id": "D"',
    '{"items": "odd"}',
    None,
]


def sent(spark):
    rows = [("purchases", t, RUN) for t in TEXTS]
    return spark.createDataFrame(rows, "topic string, json_data string, event_time timestamp")


def raw(spark, shape):
    return flatten(split_valid(sent(spark), shape)[0], shape, keep_json=False)


def test_rows_from_needed_fields_equal_those_from_whole_documents(spark):
    shape = only(text_schema("purchases"), build.PURCHASE_FIELDS)
    assert "items" not in shape.names and shape["customer"].dataType.names == ["customer_id"]
    valid, _ = split_valid_rows(build.typed_purchases(raw(spark, "purchases")), build.REQUIRED_PURCHASE)
    want = latest_by_key(valid, MART_KEYS["fact_purchases"])
    got = build.purchase_rows(raw(spark, shape))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert sorted(str(r.total_amount) for r in got.collect()) == ["2.00", "3.00"]


def test_amounts_are_read_once(spark):
    plan = build.purchase_rows(raw(spark, "purchases"))._jdf.queryExecution().optimizedPlan().toString()
    assert len([x for x in plan.splitlines() if re.search(r"try_cast|regexp_replace|cast\(", x) and "total_amount" in x]) == 1


def test_unknown_fields_are_refused():
    with pytest.raises(ValueError, match="nothing"):
        only(text_schema("purchases"), ["nothing"])
