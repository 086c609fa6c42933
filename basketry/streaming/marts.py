"""Envelope stream to mart tables, batch by batch, with the builders of the batch run.

A mart is a log (``streaming.log``): the rows each micro-batch appended, dealt to buckets by key and
compacted as batches come. A replayed batch replaces its own folder, so a replay changes nothing.
Readers take the newest row per key; lookups of a batch open only the buckets of its keys. So the
cost of a micro-batch follows the batch and what it looks up, not the size or the age of the tables.

Purchases whose address no one has sent so far wait in a log of their own, in buckets of their
place. A batch that brings addresses calls the purchases waiting for them, which are then built
again with the key of their address: purchases may come before addresses. However many wait, they
are called by shares of these buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry.functions.dates import Moment
from basketry.operators.dedup import latest_by_key
from basketry.operators.flatten import flatten
from basketry.operators.retention import retain
from basketry.plans import marts as build
from basketry.plans.daily import FACTS, STEPS, WAITING
from basketry.schemas import BUCKET_KEYS, ENTITIES, FACT_DAYS, MART_KEYS, VERSION
from basketry.sources.envelopes import judge
from basketry.sources.tables import write_table
from basketry.streaming.log import (
    BATCH,
    append,
    bucket_of,
    compact_log,
    read_log,
    release,
    shares,
    skip,
    touched,
)

# The entity that most envelopes are of.
MOST = "purchases"
PLACE = BUCKET_KEYS["addresses"]
WAITING_PLACE = tuple(f"to_{c}" for c in PLACE)
# The entities that bring rows to a mart, by themselves or by calling rows that wait.
FED_BY = {
    "addresses": ("customers", "stores"),
    "categories": ("products",),
    "manufacturers": ("products",),
    "store_networks": ("stores",),
    "store_managers": ("stores",),
    "dim_customers": ("customers",),
    "dim_products": ("products",),
    "dim_stores": ("stores",),
    "store_categories": ("stores",),
    "fact_purchases": ("purchases", "customers", "stores"),
    "fact_purchase_items": ("purchases",),
}


def _buckets(table: str) -> tuple[str, ...]:
    return BUCKET_KEYS.get(table, MART_KEYS[table])


def read_mart(
    spark: SparkSession, base: str, table: str, within: DataFrame | None = None
) -> DataFrame:
    """Current rows of a mart table: the newest per key over all batches.

    ``within`` holds values for the columns the table is bucketed by; only those buckets are
    opened and only those keys are read on.
    """
    cols = _buckets(table)
    log = read_log(spark, f"{base}/{table}", None if within is None else touched(within, cols))
    if within is not None:
        same = [log[c].eqNullSafe(within[c]) for c in cols]
        log = log.join(within, same, "left_semi")
    return latest_by_key(log, MART_KEYS[table])


def compact(
    spark: SparkSession, base: str, table: str, out: str, as_of: Moment | None = None
) -> DataFrame:
    """Write the current rows as a plain table to ``out``, facts only within their retention."""
    rows = read_mart(spark, base, table)
    if table in FACTS:
        if as_of is not None:
            rows = retain(rows, VERSION, FACT_DAYS, as_of)
        write_table(rows, out, sort=("purchase_id",), month_of="purchase_datetime")
    else:
        write_table(rows, out)
    return spark.read.parquet(out)


def settle(spark: SparkSession, base: str, table: str, out: str) -> DataFrame:
    """Write the current rows to ``out``, one share of the buckets after another."""
    path = f"{base}/{table}"
    for own in shares(spark, path):
        rows = latest_by_key(read_log(spark, path, own), MART_KEYS[table])
        shape = rows.schema
        rows.write.mode("append").parquet(out, compression="zstd")
        del rows
        release(spark)
    return spark.read.schema(shape).parquet(out)


def _called(spark: SparkSession, base: str, brought: DataFrame) -> Iterator[DataFrame]:
    """Purchases that wait for one of these addresses, with its key, a share of them at a time."""
    path = f"{base}/{WAITING}"
    for own in shares(spark, path, touched(brought, PLACE)):
        waiting = read_log(spark, path, own)
        if waiting is not None and own:
            near = brought.filter(bucket_of(PLACE).isin(own))
            addresses = read_mart(spark, base, "addresses", near.select(*PLACE).distinct())
            yield build.place_purchases(build.called(waiting, near), addresses)
            release(spark)


def _compact_all(spark: SparkSession, base: str, batch_id: int) -> None:
    for table, keys in MART_KEYS.items():
        compact_log(spark, f"{base}/{table}", batch_id, keys, _buckets(table))

    def waits(rows: DataFrame) -> DataFrame:
        """Without the purchases whose address is known by now."""
        places = rows.select(*(F.col(w).alias(c) for w, c in zip(WAITING_PLACE, PLACE, strict=True))).distinct()
        return build.unplaced(build.place_purchases(rows, read_mart(spark, base, "addresses", places)))

    compact_log(
        spark, f"{base}/{WAITING}", batch_id, MART_KEYS["fact_purchases"], WAITING_PLACE, keep=waits
    )


def build_batch(base: str, items: str = "all") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: transforms one batch of envelopes and appends to every mart.

    References are written before the dimensions and facts that look them up, so rows meet
    what earlier batches or this one brought. The envelopes are read once: purchases are parsed on the way
    and their flat rows stored for the time of the batch, as far as a mart reads them, beside the texts
    of other entities, each parsed once from there. Marts that none of its entities feeds are left alone.
    """

    def build_one(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept: list[DataFrame] = []

        def keep(df: DataFrame) -> DataFrame:
            kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
            return kept[-1]

        try:
            release(spark)
            _compact_all(spark, base, batch_id)
            most = F.col("topic") == MOST
            judged = judge(batch, MOST, most)
            unread = F.when(F.col("reason").isNotNull() | ~most, F.col("json_data"))
            flat = flatten(judged.withColumn("json_data", unread), MOST, also=("topic", "reason"))
            read = keep(flat.select("topic", "json_data", "reason", *build.purchase_columns(items)))
            came = {r[0] for r in read.select("topic").distinct().collect()}
            raw = {}
            for entity in ENTITIES:
                sent = read.filter(F.col("topic") == entity) if entity in came else read.limit(0)
                if entity == MOST:
                    flat = sent.drop("topic")
                else:
                    judged = judge(sent.select("topic", "json_data", VERSION), entity)
                    unread = F.when(F.col("reason").isNotNull(), F.col("json_data"))
                    flat = flatten(judged.withColumn("json_data", unread), entity, also=("reason",))
                    flat = keep(flat)
                raw[entity] = flat.filter(F.col("reason").isNull()).drop("json_data", "reason")
                bad = flat.filter(F.col("reason").isNotNull())
                folder = f"{base}/quarantine/topic={entity}/{BATCH}={batch_id}"
                bad.select("json_data", VERSION, "reason").write.mode("overwrite").parquet(folder)
            # Addresses grow with the customers, so they are looked up by the batch's places.
            places = keep(build.places(raw["customers"], raw["stores"], raw["purchases"]))
            current = _Current(spark, base, {"addresses": places})
            for name, step in STEPS:
                if came.isdisjoint(FED_BY[name]) and skip(spark, f"{base}/{name}", batch_id):
                    continue
                if name == "fact_purchases":
                    rows = build.purchase_rows(raw["purchases"])
                    placed = keep(build.place_purchases(rows, current["addresses"]))
                    append(build.unplaced(placed), f"{base}/{WAITING}", batch_id, WAITING_PLACE)
                    rows = build.placed_facts(placed)
                else:
                    rows = step(raw, current, items)
                append(rows, f"{base}/{name}", batch_id, _buckets(name))
                if name == "fact_purchases" and not came.isdisjoint(FED_BY["addresses"]):
                    brought = keep(build.addresses(raw["customers"], raw["stores"]))
                    for called in _called(spark, base, brought):
                        facts = build.placed_facts(called)
                        append(facts, f"{base}/{name}", batch_id, _buckets(name), more=True)
                        del called, facts
        finally:
            for df in kept:
                df.unpersist()

    return build_one


class _Current(Mapping):
    """Mart tables as they stand when looked up, some only within given keys."""

    def __init__(self, spark: SparkSession, base: str, within: Mapping[str, DataFrame]):
        self._spark, self._base, self._within = spark, base, within

    def __getitem__(self, table: str) -> DataFrame:
        return read_mart(self._spark, self._base, table, self._within.get(table))

    def __iter__(self):
        return iter(MART_KEYS)

    def __len__(self) -> int:
        return len(MART_KEYS)


def stream_marts(
    envelopes: DataFrame, base: str, checkpoint: str, items: str = "all"
) -> StreamingQuery:
    """Feed an envelope stream into the marts, everything available, then stop."""
    return (
        envelopes.writeStream.foreachBatch(build_batch(base, items))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
