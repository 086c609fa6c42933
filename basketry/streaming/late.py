"""Duplicate suppression that keeps what comes too late, in a table of its own.

Spark drops rows behind the watermark without a trace. Here every micro-batch is held against the
watermark that the batches before it left: rows behind it go to ``late``, the first row of a key
not seen yet goes to ``out``. Keys seen lie in a log (``streaming.log``) of buckets; those behind
the watermark leave it when it is compacted. All that a batch writes is under its id, so a replay
replaces it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry.schemas import VERSION
from basketry.sources import files
from basketry.streaming.log import BATCH, append, compact_log, read_log, touched


def _mark(spark: SparkSession, base: str, batch_id: int) -> int | None:
    """Greatest time, in microseconds, of the batches before this one."""
    before = [int(n) for n in files.names(spark, f"{base}/marks") if n.isdigit() and int(n) < batch_id]
    text = files.read_text(spark, f"{base}/marks/{max(before)}") if before else ""
    return int(text) if text else None


def _set_mark(spark: SparkSession, base: str, batch_id: int, newest: int | None) -> None:
    files.delete(spark, f"{base}/marks/{batch_id}")
    files.write_text(spark, f"{base}/marks/{batch_id}", "" if newest is None else str(newest))
    for n in files.names(spark, f"{base}/marks"):
        if n.isdigit() and int(n) < batch_id - 1:
            files.delete(spark, f"{base}/marks/{n}")


def dedup_batch(
    base: str, keys: Sequence[str], delay: str, ts: str = VERSION
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes ``out`` and ``late`` under ``base``.

    A row is late if its time lies more than ``delay`` (an interval) behind the newest time of all
    batches before. Rows without a time are late, too.
    """

    def build_one(batch: DataFrame, batch_id: int) -> None:
        spark, own = batch.sparkSession, list(keys)
        micros = F.unix_micros(F.col(ts).cast("timestamp"))
        newest = _mark(spark, base, batch_id)
        allowed = F.unix_micros(F.timestamp_micros(F.lit(newest).cast("long")) - F.expr(f"interval {delay}"))
        in_time = F.col(ts).isNotNull() if newest is None else F.coalesce(micros >= allowed, F.lit(False))

        def unexpired(rows: DataFrame) -> DataFrame:
            return rows if newest is None else rows.filter(micros >= allowed)

        compact_log(spark, f"{base}/seen", batch_id, own, own, ts, keep=unexpired)
        sent = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sent.filter(~in_time).write.mode("overwrite").parquet(f"{base}/late/{BATCH}={batch_id}")
            earliest = F.min(F.struct(F.col(ts).alias("_ts"), *(c for c in sent.columns if c not in own))).alias("_row")
            rest = [F.col(f"_row.{c}") for c in sent.columns if c not in own]
            first = sent.filter(in_time).groupBy(*own).agg(earliest).select(*own, *rest).select(sent.columns)
            seen = read_log(spark, f"{base}/seen", touched(sent, own))
            if seen is not None:
                # Keys that this batch itself left before it was replayed are not held against it.
                others = unexpired(seen).filter(F.col(BATCH) != batch_id)
                same = [first[k].eqNullSafe(others[k]) for k in own]
                first = first.join(others, same, "left_anti")
            first.write.mode("overwrite").parquet(f"{base}/out/{BATCH}={batch_id}")
            stored = spark.read.schema(first.schema).parquet(f"{base}/out/{BATCH}={batch_id}")
            append(stored.select(*own, ts, F.lit(batch_id).cast("long").alias(BATCH)), f"{base}/seen", batch_id, own)
            most = sent.filter(in_time).agg(F.max(micros)).first()[0]
            _set_mark(spark, base, batch_id, max((x for x in (most, newest) if x is not None), default=None))
        finally:
            sent.unpersist()

    return build_one


def dedup_with_late(
    df: DataFrame, keys: Sequence[str], delay: str, base: str, checkpoint: str, ts: str = VERSION
) -> StreamingQuery:
    """Feed everything available through ``dedup_batch``, then stop."""
    return (
        df.writeStream.foreachBatch(dedup_batch(base, keys, delay, ts))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
