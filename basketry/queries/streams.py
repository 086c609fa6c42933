"""Streaming jobs over the given tables, run until everything available is consumed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.queries import retail
from basketry.queries.marts import FACT_PURCHASES, shown_purchases
from basketry.queries.registry import Source, query
from basketry.schemas import ENTITIES
from basketry.session import scratch_dir
from basketry.sources.envelopes import read_envelopes, write_envelopes
from basketry.streaming.log import release
from basketry.streaming.marts import read_mart, settle, stream_marts
from basketry.streaming.raw import dedup_stream, run_available, stream_raw


@query(
    "stream_raw_append",
    """
    SELECT 'PRD-' || p_partkey AS id, p_retailprice AS price, p_size::VARCHAR AS expiry_days,
           '202402' AS ym FROM part
    """,
)
def stream_raw_append(t: Source) -> DataFrame:
    base = scratch_dir(t.spark, "stream-raw")
    write_envelopes(retail.envelopes(t, "products"), f"{base}/in")
    sent = read_envelopes(t.spark, f"{base}/in", ["products"], streaming=True)
    run_available(stream_raw(sent, "products", f"{base}/raw", f"{base}/checkpoint"))
    return t.spark.read.parquet(f"{base}/raw").select(
        "id",
        F.col("price").cast("double").alias("price"),
        "expiry_days",
        F.col("ym").cast("string").alias("ym"),
    )


# Packed envelopes of a micro-batch; what a batch stores and shuffles is bounded with it.
BATCH_BYTES = 256 * 1024 * 1024
# Envelopes are sent in slices, the next once the one before is consumed: so many documents, but
# no more than so many slices.
SLICE_ROWS, SLICES = 2_000_000, 12


def _purchases_by_stream(t: Source, *turns: Sequence[str]) -> DataFrame:
    """The purchases after the envelopes of some entities came, in batches, then the next ones'."""
    base = scratch_dir(t.spark, "stream-marts")
    for entities in turns:
        sliced = {e: retail.slices(t, e, SLICE_ROWS, SLICES) for e in entities}
        for k in range(max(map(len, sliced.values()))):
            for entity, own in sliced.items():
                if k < len(own):
                    write_envelopes(retail.envelopes(own[k], entity), f"{base}/in")
            sent = read_envelopes(
                t.spark, f"{base}/in", streaming=True, max_bytes=BATCH_BYTES, consume=True
            )
            run_available(stream_marts(sent, f"{base}/marts", f"{base}/checkpoint"))
            release(t.spark)
    facts = settle(t.spark, f"{base}/marts", "fact_purchases", f"{base}/current/fact_purchases")
    streets = read_mart(t.spark, f"{base}/marts", "addresses").select(
        F.col("address_id").alias("delivery_address_id"),
        F.col("street").alias("delivery_street"),
    )
    return shown_purchases(facts, streets)


@query("stream_marts", FACT_PURCHASES)
def marts_by_stream(t: Source) -> DataFrame:
    return _purchases_by_stream(t, ENTITIES)


@query("stream_marts_late", FACT_PURCHASES)
def marts_with_late_addresses(t: Source) -> DataFrame:
    """Purchases come a batch before the customers whose addresses they name."""
    return _purchases_by_stream(t, ("purchases",), ("products", "stores", "customers"))


@query(
    "stream_dedup",
    "SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids FROM events GROUP BY 1",
)
def stream_dedup(t: Source) -> DataFrame:
    """Every event sent twice, kept once."""
    base = scratch_dir(t.spark, "stream-dedup")
    schema = t.events.schema
    sent = (
        t.spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(t.folder)
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    once = dedup_stream(sent.unionAll(sent), ["event_id"], "1 day", "ts")
    run_available(
        once.writeStream.format("parquet")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{base}/out")
    )
    return (
        t.spark.read.schema(once.schema)
        .parquet(f"{base}/out")
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))
    )
