"""Stored tables over the given ones: merged slice by slice, expired, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.queries.registry import Source, query
from basketry.session import scratch_dir
from basketry.sources.snapshots import Snapshot, read_snapshot

_SLICES = 3


def _stored_orders(t: Source) -> str:
    """The newest line of every order, merged from three slices of the lines, a commit each.

    The month a row is kept in is that of its ship date, so an order leaves its month whenever a
    later slice has a newer line of it.
    """
    base = scratch_dir(t.spark, "upsert")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_shipdate").cast("timestamp").alias("event_time"))
    for k in range(_SLICES):
        snapshot = Snapshot(t.spark, base)
        rows = lines.filter(F.col("l_linenumber") % _SLICES == k)
        snapshot.merge("orders", rows, ["l_orderkey"], month_of="event_time")
        snapshot.commit()
        snapshot.vacuum()
    return base


_NEWEST = """
    SELECT l_orderkey, l_linenumber, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS day FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_shipdate DESC, l_linenumber DESC, l_suppkey DESC) AS rn FROM lineitem)
    WHERE rn = 1
"""


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select("l_orderkey", "l_linenumber", "l_suppkey", F.date_format("event_time", "yyyy-MM-dd").alias("day"))


@query("daily_upsert", _NEWEST)
def daily_upsert(t: Source) -> DataFrame:
    return _shown(read_snapshot(t.spark, _stored_orders(t), "orders"))


@query(
    "stored_expiry",
    f"SELECT * FROM ({_NEWEST}) WHERE day >= (SELECT strftime(max(l_shipdate) - INTERVAL 360 DAY, '%Y-%m-%d') FROM lineitem)",
)
def stored_expiry(t: Source) -> DataFrame:
    """Months before the limit leave the table unread, the border month is written again."""
    snapshot = Snapshot(t.spark, _stored_orders(t))
    newest = t.lineitem.agg(F.max(F.col("l_shipdate").cast("timestamp"))).first()[0]
    snapshot.expire("orders", 360, newest)
    snapshot.commit()
    return _shown(read_snapshot(t.spark, snapshot.base, "orders"))
