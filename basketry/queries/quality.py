"""Profiles, counts, duplicate reports and alerts over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.dedup import head
from basketry.operators.quality import (
    duplicate_alerts,
    duplicate_rate,
    duplicate_report,
    profile,
    table_counts,
)
from basketry.operators.sketches import (
    daily_sketches,
    estimated_duplicate_rate,
    merged,
    within_bound,
)
from basketry.queries.registry import Source, query
from basketry.session import scratch_dir

_TABLES = ("customer", "lineitem", "orders", "part", "supplier")


@query(
    "table_counts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in _TABLES
    ),
)
def counts(t: Source) -> DataFrame:
    return table_counts({name: getattr(t, name) for name in _TABLES})


@query(
    "table_profile",
    """
    SELECT 'documents' AS table_name, count(*) AS row_count,
           (SELECT count(*) FROM (SELECT doc_id FROM documents LIMIT 3)) AS first_rows
    FROM documents
    """,
)
def table_profile(t: Source) -> DataFrame:
    total, first = profile(t.documents)
    shown = head(first, 3).agg(F.count(F.lit(1)).alias("first_rows"))
    stacked = total.select("row_count", F.lit(None).cast("long").alias("first_rows")).unionAll(
        shown.select(F.lit(None).cast("long"), "first_rows")
    )
    return stacked.agg(
        F.max("row_count").alias("row_count"), F.max("first_rows").alias("first_rows")
    ).select(F.lit("documents").alias("table_name"), "*")


def _rate(key: str, table: str, where: str = "true") -> str:
    return f"""(SELECT CASE WHEN count({key}) = 0 THEN 0 ELSE round_even(
        (1 - count(DISTINCT {key}) / count({key})) * 100, 0) END::INT
        FROM {table} WHERE {where})"""


_DAY = "l_shipdate::DATE = (SELECT max(l_shipdate) FROM lineitem)::DATE - 30"


@query(
    "duplicate_rate_report",
    f"""
    SELECT strftime((SELECT max(l_shipdate) FROM lineitem) - INTERVAL 30 DAY, '%Y-%m-%d') AS day,
           {_rate("l_orderkey", "lineitem", _DAY)} AS duplicate_purchases,
           {_rate("l_suppkey", "lineitem", _DAY)} AS duplicate_stores,
           {_rate("l_returnflag", "lineitem", _DAY)} AS duplicate_flags
    """,
)
def duplicate_rate_report(t: Source) -> DataFrame:
    day = t.lineitem.agg(F.max("l_shipdate") - F.expr("interval 30 days")).scalar()
    entities = {"purchases": "l_orderkey", "stores": "l_suppkey", "flags": "l_returnflag"}
    raw = {name: (t.lineitem, key) for name, key in entities.items()}
    report = duplicate_report(raw, day, version="l_shipdate")
    return report.select(
        F.date_format("event_time", "yyyy-MM-dd").alias("day"),
        *(F.col(f"duplicate_{name}").cast("int").alias(f"duplicate_{name}") for name in entities),
    )


@query(
    "duplicate_alert",
    f"""
    WITH rates AS (SELECT 'flags' AS entity, {_rate("l_returnflag", "lineitem")} AS rate
                   UNION ALL SELECT 'purchases', {_rate("l_orderkey", "lineitem")}
                   UNION ALL SELECT 'orders', {_rate("o_orderkey", "orders")}
                   UNION ALL SELECT 'stores', {_rate("l_suppkey", "lineitem")})
    SELECT entity, rate FROM rates WHERE rate > 50
    """,
)
def duplicate_alert(t: Source) -> DataFrame:
    tables = {
        "flags": (t.lineitem, "l_returnflag"),
        "purchases": (t.lineitem, "l_orderkey"),
        "orders": (t.orders, "o_orderkey"),
        "stores": (t.lineitem, "l_suppkey"),
    }
    stamped = {
        name: (df.withColumn("event_time", F.lit("2024-02-01 07:00:00").cast("timestamp")), key)
        for name, (df, key) in tables.items()
    }
    alerts = duplicate_alerts(duplicate_report(stamped, "2024-02-01 12:00:00"))
    return alerts.select(
        F.regexp_replace("entity", "duplicate_", "").alias("entity"),
        F.col("rate").cast("int").alias("rate"),
    )


@query(
    "duplicate_rate_by_month",
    """
    SELECT strftime(l_shipdate, '%Y%m') AS ym,
           round_even((1 - count(DISTINCT l_suppkey) / count(l_suppkey)) * 100, 0)::INT AS rate
    FROM lineitem GROUP BY 1
    """,
)
def duplicate_rate_by_month(t: Source) -> DataFrame:
    return t.lineitem.groupBy(F.date_format("l_shipdate", "yyyyMM").alias("ym")).agg(
        duplicate_rate(F.col("l_suppkey")).cast("int").alias("rate")
    )


@query("duplicate_rate_approximate")
def duplicate_rate_approximate(t: Source) -> DataFrame:
    """The estimated form of the rate; estimates have no exact SQL counterpart."""
    return t.lineitem.agg(
        duplicate_rate(F.col("l_orderkey"), approx=True).cast("int").alias("rate")
    )


@query(
    "distinct_by_sketch",
    """
    SELECT strftime(l_shipdate, '%Y%m') AS ym, count(l_orderkey) AS n_keys, true AS count_within, true AS rate_within
    FROM lineitem GROUP BY 1
    """,
)
def distinct_by_sketch(t: Source) -> DataFrame:
    """Sketches stored per day and merged by month, held against the exact counts."""
    path, month = scratch_dir(t.spark, "sketches"), F.date_format("day", "yyyyMM").alias("ym")
    daily_sketches(t.lineitem, "l_orderkey", "l_shipdate").write.parquet(path)
    exact = t.lineitem.groupBy(F.date_format("l_shipdate", "yyyyMM").alias("ym")).agg(
        F.count_distinct("l_orderkey").alias("exact"),
        duplicate_rate(F.col("l_orderkey")).alias("rate"),
    )
    rate = estimated_duplicate_rate(F.col("n_keys"), F.col("n_distinct"))
    return merged(t.spark.read.parquet(path), month).join(exact, "ym").select(
        "ym",
        "n_keys",
        within_bound(F.col("n_distinct"), F.col("exact")).alias("count_within"),
        (F.abs(rate - F.col("rate")) <= 5).alias("rate_within"),
    )
