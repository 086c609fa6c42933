"""The daily run over the document fixtures: mart row counts and the golden matrix."""

import csv
import glob
import os
from datetime import datetime, timedelta

from support import AS_OF, DOCUMENTS, GOLDEN, needs_documents
from pyspark.sql import functions as F

from basketry.operators.quality import table_counts
from basketry.plans.daily import alerts, build_marts, ingest, publish, read_marts, read_raw
from basketry.plans.features import FLAG_NAMES, category_bits, feature_matrix
from basketry.schemas import ENTITIES
from basketry.sources.documents import load_all, read_entity, read_unreadable
from basketry.sources.exports import export_csv
from basketry.sources.tables import list_tables, register_catalog, write_months

pytestmark = needs_documents

MART_ROWS = {
    "addresses": 90, "categories": 5, "manufacturers": 17, "store_networks": 2,
    "store_managers": 45, "dim_customers": 45, "dim_products": 20, "dim_stores": 45,
    "store_categories": 225, "fact_purchases": 200, "fact_purchase_items": 383,
}


def stored(spark, out):
    return read_marts(spark, out)


def test_mart_row_counts(spark, full_run):
    counts = table_counts(stored(spark, full_run[0])).collect()
    assert {r.table_name: r.row_count for r in counts} == MART_ROWS


def test_lookups_found(spark, full_run):
    t = stored(spark, full_run[0])
    assert t["dim_customers"].dropna(subset=["address_id", "delivery_address_id"]).count() == 45
    assert t["dim_products"].filter("manufacturer_id is null").count() == 3
    assert t["dim_products"].filter("category_id is null").count() == 0
    whole = t["dim_stores"].dropna(subset=["address_id", "manager_id", "store_network_id"])
    assert whole.count() == 45
    assert t["fact_purchases"].dropna(subset=["delivery_address_id"]).count() == 200
    assert t["store_categories"].filter("category_id = 0").count() == 0


def test_golden_matrix_cell_by_cell(golden_run):
    with open(GOLDEN, newline="", encoding="utf-8") as f:
        want = sorted(tuple(r.values()) for r in csv.DictReader(f))
    out, matrix = golden_run
    assert sorted(tuple(str(v) for v in r) for r in matrix.collect()) == want
    (exported,) = glob.glob(f"{out}/exports/*.csv")
    assert os.path.basename(exported) == os.path.basename(GOLDEN)
    with open(exported, newline="", encoding="utf-8") as f:
        assert sorted(tuple(r) for r in csv.reader(f))[:-1] == want


def test_results_are_exported_in_parts(golden_run, tmp_path):
    matrix = golden_run[1]
    path = export_csv(matrix.repartition(3), str(tmp_path), AS_OF)
    parts = glob.glob(f"{path}/part-*.csv")
    assert len(parts) == 3
    assert matrix.sparkSession.read.option("header", True).csv(path).count() == 45


def test_corrected_sums(full_run):
    sums = full_run[1].agg(*(F.sum(n).alias(n) for n in FLAG_NAMES)).first().asDict()
    want = {
        "organic_preference": 42, "buys_bakery": 26, "prefers_cash": 10, "prefers_card": 6,
        "single_item_buyer": 19, "varied_shopper": 27, "vegetarian_profile": 16,
        "not_bought_veggies_14d": 44, "inactive_14_30": 45, "delivery_user": 38,
        "bulk_buyer": 18, "loyal_customer": 36, "multicity_buyer": 41, "weekday_shopper": 43,
        "store_loyal": 3, "switching_store": 41, "early_bird": 43, "no_purchases": 1,
    }
    assert {k: sums[k] for k in want} == want


def test_one_of_three_store_flags_holds(full_run):
    flags = F.col("store_loyal") + F.col("switching_store") + F.col("no_purchases")
    assert full_run[1].filter(flags != 1).count() == 0


def test_many_categories_take_the_pair_path(spark, full_run, monkeypatch):
    from basketry.plans import features

    marts = stored(spark, full_run[0])
    assert len(category_bits(marts["dim_products"])) == 5
    monkeypatch.setattr(features, "MASK_BITS", 1)
    assert category_bits(marts["dim_products"]) is None
    monkeypatch.setattr(features, "MASK_WORDS", 5)
    several_words = feature_matrix(marts, AS_OF)
    monkeypatch.setattr(features, "MASK_WORDS", 4)
    by_pairs = feature_matrix(marts, AS_OF)
    want = sorted(map(tuple, full_run[1].collect()))
    assert sorted(map(tuple, several_words.collect())) == want
    assert sorted(map(tuple, by_pairs.collect())) == want


def test_feature_plan(spark, full_run):
    plan = feature_matrix(stored(spark, full_run[0]), AS_OF)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text and "Expand" not in text
    for fact in ("fact_purchases,", "fact_purchase_items,", "dim_customers,"):
        assert text.count(f"/{fact[:-1]}]") <= 1


def test_second_load_same_day_changes_marts_nothing_and_is_reported(spark, tmp_path):
    out, run = str(tmp_path), datetime(2025, 9, 5, 7)
    for hour in range(3):
        at = run + timedelta(hours=hour)
        publish(spark, DOCUMENTS, f"{out}/envelopes/{hour}", at)
        ingest(spark, f"{out}/envelopes/{hour}", out, at)
    raw = read_raw(spark, out, run)
    assert raw["products"].count() == 60
    build_marts(spark, raw, out, run + timedelta(days=1))
    counts = table_counts(stored(spark, out)).collect()
    assert {r.table_name: r.row_count for r in counts} == MART_ROWS
    from basketry.operators.quality import duplicate_report
    from basketry.schemas import ENTITY_ID

    report = duplicate_report({e: (raw[e], ENTITY_ID[e]) for e in ENTITIES}, run)
    report.write.parquet(f"{out}/marts/duplicate_analysis_results")
    assert {r.rate for r in alerts(spark, out).collect()} == {67}


def test_sources(spark, tmp_path):
    base = tmp_path / "docs"
    for entity in ENTITIES:
        (base / entity).mkdir(parents=True)
    (base / "products" / "a.json").write_text('{\n"id": "p1", "price": 2.5}')
    (base / "products" / "b.json").write_text('{"id": "p2", "price": "abc"}')
    (base / "products" / "c.json").write_text('{"id": ')
    docs = read_entity(spark, f"{base}/products", "products").collect()
    assert sorted((r.id, r.price) for r in docs) == [("p1", 2.5), ("p2", None)]
    (bad,) = read_unreadable(spark, f"{base}/products", "products").collect()
    assert bad.file.endswith("c.json")
    for _ in range(2):
        load_all(spark, str(base), f"{tmp_path}/stored", entities=["products"])
    spark.range(1).write.parquet(f"{tmp_path}/stored/mv_x")
    assert list_tables(spark, f"{tmp_path}/stored") == ["products"]
    assert register_catalog(spark, f"{tmp_path}/stored") == ["products"]
    assert spark.sql("select count(*) from products").first()[0] == 2


def test_replacing_months_is_repeatable(spark, tmp_path):
    path = f"{tmp_path}/t"
    days = spark.createDataFrame(
        [(1, datetime(2024, 1, 5)), (2, datetime(2024, 2, 5))], "i int, d timestamp"
    )
    write_months(days, path, "d")
    for _ in range(2):
        write_months(days.filter("i = 2").withColumn("i", F.lit(3)), path, "d")
    assert sorted(r.i for r in spark.read.parquet(path).collect()) == [1, 3]
