"""Envelope stream to RAW tables, bounded runs, duplicate suppression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry.functions.dates import month_key
from basketry.operators.flatten import flatten
from basketry.schemas import VERSION
from basketry.sources.envelopes import split_valid
from basketry.sources.tables import MONTH


def _append(df: DataFrame, out: str, checkpoint: str, months: bool) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.partitionBy(MONTH) if months else writer
    return writer.outputMode("append").trigger(availableNow=True).start(out)


def stream_raw(envelopes: DataFrame, entity: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append a topic's envelopes to its RAW table. The checkpoint moves on only after a batch
    is written, and the file sink lists each batch once, so a restart loses and repeats nothing.
    """
    good, _ = split_valid(envelopes.filter(F.col("topic") == entity), entity)
    monthly = flatten(good, entity).withColumn(MONTH, month_key(F.col(VERSION)))
    return _append(monthly, out, checkpoint, months=True)


def stream_quarantine(
    envelopes: DataFrame, entity: str, out: str, checkpoint: str
) -> StreamingQuery:
    """Append the topic's unusable envelopes, with the reason, to a table of their own."""
    _, bad = split_valid(envelopes.filter(F.col("topic") == entity), entity)
    return _append(bad, out, checkpoint, months=False)


def run_available(query: StreamingQuery, seconds: int | None = None) -> bool:
    """Wait until everything available at the start is consumed, or the time budget is spent.

    A query stopped by the budget continues from its checkpoint at the next start.
    """
    if seconds is None:
        query.awaitTermination()
        return True
    done = query.awaitTermination(seconds)
    if not done:
        query.stop()
    return bool(done)


def dedup_stream(
    df: DataFrame, keys: Sequence[str], delay: str, ts: str = VERSION
) -> DataFrame:
    """Drop repeats of a key arriving within ``delay``; the watermark lets old state go."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
