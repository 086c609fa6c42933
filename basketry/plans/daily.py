"""The daily run: documents -> masked envelopes -> RAW -> marts -> report -> flags -> CSV."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.dates import moment, month_key
from basketry.operators.dedup import latest_by_key
from basketry.operators.flatten import flatten
from basketry.operators.masking import mask_json, mask_text
from basketry.operators.quality import duplicate_alerts, duplicate_report
from basketry.operators.retention import retain
from basketry.plans import marts as build
from basketry.plans.features import feature_matrix
from basketry.schemas import (
    BUCKET_KEYS,
    ENTITIES,
    ENTITY_ID,
    FACT_DAYS,
    MART_KEYS,
    RAW_DAYS,
    SENSITIVE,
    VERSION,
)
from basketry.sources import files
from basketry.sources.documents import read_broken, read_documents
from basketry.sources.envelopes import (
    read_envelopes,
    read_unrouted,
    split_valid,
    text_envelope,
    write_envelopes,
)
from basketry.sources.exports import export_csv
from basketry.sources.snapshots import Snapshot, bucket
from basketry.sources.tables import MONTH, RUN, drop_months, write_run

FACTS = ("fact_purchases", "fact_purchase_items")
WAITING = "waiting_purchases"

Tables = Mapping[str, DataFrame]

# References first, then dimensions, then the bridge and the facts: each step reads the tables
# before it. Sort columns keep rows of a key together in the files.
STEPS: tuple[tuple[str, Callable[[Tables, Tables, str], DataFrame]], ...] = (
    ("addresses", lambda raw, t, i: build.addresses(raw["customers"], raw["stores"])),
    ("categories", lambda raw, t, i: build.categories(raw["products"])),
    ("manufacturers", lambda raw, t, i: build.manufacturers(raw["products"])),
    ("store_networks", lambda raw, t, i: build.store_networks(raw["stores"])),
    ("store_managers", lambda raw, t, i: build.store_managers(raw["stores"])),
    ("dim_customers", lambda raw, t, i: build.dim_customers(raw["customers"], t["addresses"])),
    (
        "dim_products",
        lambda raw, t, i: build.dim_products(raw["products"], t["manufacturers"], t["categories"]),
    ),
    (
        "dim_stores",
        lambda raw, t, i: build.dim_stores(
            raw["stores"], t["store_networks"], t["store_managers"], t["addresses"]
        ),
    ),
    (
        "store_categories",
        lambda raw, t, i: build.store_categories(raw["stores"], t["categories"]),
    ),
    ("fact_purchases", lambda raw, t, i: build.fact_purchases(raw["purchases"], t["addresses"])),
    ("fact_purchase_items", lambda raw, t, i: build.fact_purchase_items(raw["purchases"], i)),
)


def publish(spark: SparkSession, documents: str, envelopes: str, run_time: datetime) -> None:
    """Mask every entity's documents and write them as the envelopes of one run.

    A document travels as the text it came in, with only its personal values changed, so fields
    and kinds of values that no schema knows are kept. ``envelopes`` is the folder of the run; publishing it again replaces them.
    """
    for entity in ENTITIES:
        docs = read_documents(spark, f"{documents}/{entity}")
        text = mask_json(F.col("text")) if entity in SENSITIVE else F.col("text")
        files.delete(spark, f"{envelopes}/topic={entity}")
        write_envelopes(text_envelope(docs, text, entity, run_time), envelopes, "overwrite")


def ingest(
    spark: SparkSession,
    envelopes: str,
    out: str,
    run_time: datetime,
    documents: str | None = None,
) -> None:
    """Add a run's envelopes to the RAW tables, unusable ones to the quarantine table.

    Envelopes of no known topic go there as topic ``unrouted``. With the folder of the
    ``documents`` that were published, those that could not be read go there too. Phone numbers and
    e-mail addresses in the raw text are masked. Both tables keep the rows of a run apart; a retry
    first removes what an earlier attempt left, so a document mended since is no longer quarantined.
    """
    run = run_name(run_time)

    def quarantine(bad: DataFrame, topic: str) -> None:
        files.delete(spark, f"{out}/quarantine/{RUN}={run}/topic={topic}")
        kept = bad.withColumn("json_data", mask_text(F.col("json_data")))
        kept = kept.withColumn("topic", F.lit(topic)).withColumn(RUN, F.lit(run))
        kept.write.mode("append").partitionBy(RUN, "topic").parquet(f"{out}/quarantine")

    for entity in ENTITIES:
        good, bad = split_valid(read_envelopes(spark, envelopes, [entity], run_time), entity)
        write_run(flatten(good, entity), f"{out}/raw/{entity}", run)
        if documents:
            broken = read_broken(spark, f"{documents}/{entity}").select(
                F.col("text").alias("json_data"),
                moment(run_time).cast(bad.schema["event_time"].dataType).alias("event_time"),
                F.concat(F.lit("unreadable document: "), F.col("file")).alias("reason"),
            )
            bad = bad.unionByName(broken)
        quarantine(bad, entity)
    quarantine(read_unrouted(spark, envelopes, ENTITIES, run_time), "unrouted")


def run_name(run_time: datetime) -> str:
    return f"{run_time:%Y%m%dT%H%M%S}"


def _raw(spark: SparkSession, out: str, entity: str) -> DataFrame:
    """A RAW table, which may have no rows so far. Columns that older files lack are NULL."""
    none = spark.createDataFrame([], "topic string, json_data string, event_time timestamp")
    empty = flatten(split_valid(none, entity)[0], entity)
    empty = empty.withColumn(RUN, F.lit("")).withColumn(MONTH, F.lit(""))
    path = f"{out}/raw/{entity}"
    stored = any(n.startswith(f"{RUN}=") for n in files.names(spark, path))
    return spark.read.schema(empty.schema).parquet(path) if stored else empty


def read_raw_run(spark: SparkSession, out: str, run_time: datetime) -> dict[str, DataFrame]:
    """What one run brought; no other run's files are opened."""
    mine = F.col(RUN) == run_name(run_time)
    return {e: _raw(spark, out, e).filter(mine).drop(MONTH, RUN) for e in ENTITIES}


def read_raw(spark: SparkSession, out: str, as_of: datetime) -> dict[str, DataFrame]:
    """RAW tables within their retention."""
    return {
        entity: retain(_raw(spark, out, entity), VERSION, RAW_DAYS, as_of, MONTH).drop(MONTH, RUN)
        for entity in ENTITIES
    }


def read_raw_day(spark: SparkSession, out: str, day: datetime) -> dict[str, DataFrame]:
    """The month of a day in the RAW tables; other months' files are not opened."""
    month = F.col(MONTH).cast("string") == month_key(moment(day))
    return {
        entity: _raw(spark, out, entity).filter(month).drop(MONTH, RUN)
        for entity in ENTITIES
    }


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """A frame that is read several times."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


class _Draft(Mapping):
    """The mart tables as the steps so far have left them."""

    def __init__(self, snapshot: Snapshot):
        self._snapshot = snapshot

    def __getitem__(self, table: str) -> DataFrame:
        return self._snapshot.read(table)

    def __iter__(self):
        return iter(self._snapshot.tables)

    def __len__(self) -> int:
        return len(self._snapshot.tables)


def _merge_purchases(snapshot: Snapshot, raw: Tables, as_of: datetime) -> None:
    """Merge a slice's purchases, and the earlier ones whose address this slice brought.

    Purchases of an unknown address wait in buckets of their place. New addresses open only their
    own buckets, and what is found leaves them.
    """
    place = BUCKET_KEYS["addresses"]
    by_place = bucket([f"to_{c}" for c in place])
    brought = build.addresses(raw["customers"], raw["stores"])
    rows, waiting = build.purchase_rows(raw["purchases"]), None
    if WAITING in snapshot:
        opened = [r[0] for r in brought.select(bucket(place)).distinct().collect()]
        waiting = build.called(snapshot.read(WAITING, opened), brought)
        rows = latest_by_key(rows.unionByName(waiting), MART_KEYS["fact_purchases"])
    with kept(build.place_purchases(rows, snapshot.read("addresses"))) as placed:
        facts = build.placed_facts(placed)
        snapshot.merge("fact_purchases", facts, MART_KEYS["fact_purchases"], "purchase_datetime")
        still, keys = build.unplaced(placed), list(MART_KEYS["fact_purchases"])
        touched = None
        if waiting is not None:
            found = placed.filter(F.col("delivery_address_id").isNotNull())
            touched = {r[0] for r in placed.select(by_place).distinct().collect()}
            stay = snapshot.read(WAITING, touched).join(found, keys, "left_anti")
            still = latest_by_key(stay.unionByName(still), keys)
        snapshot.replace(WAITING, still, by_place, touched)
    snapshot.expire(WAITING, FACT_DAYS, as_of)


def build_marts(
    spark: SparkSession, raw: Tables, out: str, as_of: datetime, items: str = "all"
) -> dict[str, DataFrame]:
    """Merge a slice of RAW into every mart table and give the tables as stored.

    The newest row per key stays; running it again changes nothing. Only the parts that the slice
    touches are read and written: months of facts, buckets of keys of the others. Dimensions are
    kept for good, facts for their own retention. All tables change in one commit at the end, so a
    run that fails leaves all of them as they were.
    """
    snapshot = Snapshot(spark, f"{out}/marts")
    draft = _Draft(snapshot)
    for name, step in STEPS:
        if name == "fact_purchases":
            _merge_purchases(snapshot, raw, as_of)
        else:
            with kept(step(raw, draft, items)) as rows:
                month = "purchase_datetime" if name in FACTS else None
                snapshot.merge(name, rows, MART_KEYS[name], month, BUCKET_KEYS.get(name))
        if name in FACTS:
            snapshot.expire(name, FACT_DAYS, as_of)
    rejects, run = f"{out}/rejects", run_name(as_of)
    files.delete(spark, f"{rejects}/{RUN}={run}")
    build.rejects(raw, items).withColumn(RUN, F.lit(run)).write.mode("append").partitionBy(
        RUN
    ).parquet(rejects)
    snapshot.commit()
    snapshot.vacuum()
    return read_marts(spark, out)


def read_marts(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The mart tables as of the newest commit."""
    snapshot = Snapshot(spark, f"{out}/marts")
    return {name: snapshot.read(name) for name in MART_KEYS}


def run_daily(
    spark: SparkSession,
    documents: str,
    out: str,
    run_time: datetime,
    as_of: datetime | None = None,
    items: str = "all",
    compat: bool = False,
    single_csv: bool = False,
) -> DataFrame:
    """The whole run in order; gives the feature matrix, also exported as CSV (as one file only
    if ``single_csv`` asks for it)."""
    as_of = as_of or run_time
    envelopes = f"{out}/envelopes/{run_name(run_time)}"
    publish(spark, documents, envelopes, run_time)
    ingest(spark, envelopes, out, run_time, documents)
    for entity in ENTITIES:
        drop_months(spark, f"{out}/raw/{entity}", RAW_DAYS, as_of)
    marts = build_marts(spark, read_raw_run(spark, out, run_time), out, as_of, items)
    today = read_raw_day(spark, out, run_time)
    report = duplicate_report({e: (today[e], ENTITY_ID[e]) for e in ENTITIES}, run_time)
    report.write.mode("append").parquet(f"{out}/marts/duplicate_analysis_results")
    matrix_path = f"{out}/marts/feature_matrix"
    feature_matrix(marts, as_of, compat=compat).write.mode("overwrite").parquet(matrix_path)
    matrix = spark.read.parquet(matrix_path)
    export_csv(matrix, f"{out}/exports", as_of, single_csv)
    return matrix


def alerts(spark: SparkSession, out: str, threshold: int = 50) -> DataFrame:
    """Entities whose stored duplicate rate is above the threshold."""
    report = spark.read.parquet(f"{out}/marts/duplicate_analysis_results")
    return duplicate_alerts(report, threshold)
