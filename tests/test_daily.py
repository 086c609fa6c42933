"""The daily run over documents written here: accumulation, retention, retries, rejects."""

import json
from datetime import datetime, timedelta

import pytest

from basketry.plans.daily import ingest, publish, read_marts, run_daily
from basketry.schemas import ENTITIES
from basketry.sources.snapshots import Snapshot

START = datetime(2025, 1, 10, 7)
PLACE = {
    "country": "X", "city": "Y", "street": "Z", "house": "1", "postal_code": "123456",
    "coordinates": {"latitude": 1.5, "longitude": 2.5},
}


def store(key):
    return {
        "store_id": key, "store_name": "S", "store_network": "N", "type": "t",
        "store_type_description": "d", "categories": ["a b"],
        "manager": {"name": "M", "phone": "+79161234567", "email": "m@x.org"}, "location": PLACE,
        "opening_hours": {"mon_fri": "8", "sat": "9", "sun": "10"},
        "accepts_online_orders": True, "delivery_available": True, "warehouse_connected": True,
        "last_inventory_date": "2025-01-01",
    }


def product(key):
    return {
        "id": key, "name": "P", "group": "a b", "description": "d", "price": 2.5, "unit": "kg",
        "kbju": {"calories": 1.0, "protein": 1.0, "fat": 1.0, "carbohydrates": 1.0},
        "origin_country": "X", "expiry_days": 3, "is_organic": True, "barcode": "1",
        "manufacturer": {"name": "F", "country": "X", "website": "w", "inn": "77"},
    }


def customer(key, born="1990-01-01"):
    return {
        "customer_id": key, "first_name": "A", "last_name": "B", "email": "a@b.org",
        "phone": "+79161234568", "birth_date": born, "gender": "male",
        "registration_date": "2024-12-01T10:00:00.000000", "is_loyalty_member": True,
        "loyalty_card_number": "L1", "purchase_location": PLACE,
        "delivery_address": {**PLACE, "apartment": "7"},
        "preferences": {
            "preferred_language": "ru", "preferred_payment_method": "card",
            "receive_promotions": True,
        },
    }


def purchase(key, at):
    item = {
        "product_id": "p1", "name": "P", "category": "a b", "quantity": 1, "unit": "kg",
        "price_per_unit": 2.5, "total_price": 2.5, "kbju": product("p1")["kbju"],
        "manufacturer": product("p1")["manufacturer"],
    }
    who = {k: v for k, v in customer("c1").items() if not isinstance(v, dict)}
    return {
        "purchase_id": key, "customer": who,
        "store": {"store_id": "s1", "store_name": "S", "store_network": "N", "location": PLACE},
        "items": [item], "total_amount": 2.5, "payment_method": "card", "is_delivery": False,
        "delivery_address": {**PLACE, "apartment": "7"},
        "purchase_datetime": at.strftime("%Y-%m-%dT%H:%M:%S.000000"),
    }


@pytest.fixture
def documents(tmp_path):
    def write(name, **docs):
        base = tmp_path / name
        for entity in ENTITIES:
            (base / entity).mkdir(parents=True)
            for i, doc in enumerate(docs.get(entity, [])):
                (base / entity / f"{i}.json").write_text(json.dumps(doc))
        return str(base)

    return write


def rows(spark, out, name):
    return read_marts(spark, out)[name].count()


def test_marts_accumulate_beyond_the_raw_retention(spark, documents, tmp_path):
    out = str(tmp_path / "out")
    first = documents(
        "first", products=[product("p1")], stores=[store("s1"), store(" ")],
        customers=[customer("c1"), customer("c2", born="2025-01-01")],
        purchases=[purchase("o1", START)],
    )
    later = documents("later", purchases=[purchase("o2", START + timedelta(days=200))])
    for _ in range(2):  # a retry of the same run changes nothing
        run_daily(spark, first, out, START)
    assert spark.read.parquet(f"{out}/raw/purchases").count() == 1
    rejects = spark.read.parquet(f"{out}/rejects").collect()
    assert {(r.source, r.reason) for r in rejects} == {("stores", "store_id"), ("customers", "implausible dates")}
    sizes = {"dim_products": 1, "dim_stores": 1, "dim_customers": 1, "categories": 1}
    for day, facts in ((0, 1), (200, 2), (370, 1)):
        at = START + timedelta(days=day)
        if day:
            run_daily(spark, later if day == 200 else documents(f"empty{day}"), out, at)
        assert {n: rows(spark, out, n) for n in sizes} == sizes
        assert rows(spark, out, "fact_purchases") == facts


def test_publishing_and_ingesting_again_replaces(spark, documents, tmp_path):
    base, out = documents("d", products=[product("p1")]), str(tmp_path / "out")
    for _ in range(2):
        publish(spark, base, f"{out}/envelopes", START)
        ingest(spark, f"{out}/envelopes", out, START)
    assert spark.read.parquet(f"{out}/raw/products").count() == 1


def test_addresses_after_purchases_a_mended_and_a_withdrawn_document(spark, documents, tmp_path):
    out = str(tmp_path / "out")
    first = documents(
        "first", products=[product("p1")], stores=[store("s1")], purchases=[purchase("o1", START)]
    )
    broken = tmp_path / "first" / "customers" / "0.json"
    broken.write_text('{"customer_id": "c1", "phone": "+7 916 123-45-68", "email": "a@b.org"')
    run_daily(spark, first, out, START)
    assert read_marts(spark, out)["fact_purchases"].first().delivery_address_id is None
    (bad,) = spark.read.parquet(f"{out}/quarantine").collect()
    assert "123-45-68" not in bad.json_data and "a@b.org" not in bad.json_data
    # The same run again with the document mended, and a product withdrawn.
    broken.write_text(json.dumps(customer("c2")))
    (tmp_path / "first" / "products" / "0.json").unlink()
    publish(spark, first, f"{out}/envelopes/again", START)
    ingest(spark, f"{out}/envelopes/again", out, START, first)
    assert not list((tmp_path / "out" / "quarantine").glob("run=*/topic=*/*.parquet"))
    assert not list((tmp_path / "out" / "raw" / "products").glob("run=*/ym=*/*.parquet"))
    # A later run brings the customer, so the earlier purchase gets its address.
    before = Snapshot(spark, f"{out}/marts").parts("dim_products")
    run_daily(spark, documents("later", customers=[customer("c1")]), out, START + timedelta(days=1))
    fact = read_marts(spark, out)["fact_purchases"].first()
    assert fact.delivery_address_id is not None
    snapshot = Snapshot(spark, f"{out}/marts")
    assert snapshot.read("waiting_purchases").count() == 0
    assert snapshot.parts("dim_products") == before
