"""Stored tables, catalogue registration, JDBC reads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.dates import Moment, days_before, month_key
from basketry.sources import files
from basketry.sources.snapshots import Snapshot

MONTH = "ym"
RUN = "run"


def write_raw(df: DataFrame, path: str, mode: str = "append", ts: str = "event_time") -> None:
    """RAW table, one folder per month, rows of a file ordered by time.

    The rebalance hint brings a month's rows together yet splits large months, so a backfill over
    many months does not leave a file of each task in each month.
    """
    monthly = df.withColumn(MONTH, month_key(F.col(ts))).hint("rebalance", F.col(MONTH))
    monthly.sortWithinPartitions(MONTH, ts).write.mode(mode).partitionBy(MONTH).parquet(path)


def write_run(df: DataFrame, path: str, run: str, ts: str = "event_time") -> None:
    """The part of a RAW table that one run brings, by month. Repeating the run replaces it, also
    where the second attempt has no rows for a month of the first."""
    files.delete(df.sparkSession, f"{path}/{RUN}={run}")
    stamped = df.withColumn(RUN, F.lit(run)).withColumn(MONTH, month_key(F.col(ts)))
    stamped = stamped.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, ts)
    stamped.write.mode("append").partitionBy(RUN, MONTH).parquet(path)


def drop_months(spark: SparkSession, path: str, days: int, as_of: Moment) -> None:
    """Delete the months of a RAW table that lie before the limit as a whole, unread."""
    limit = spark.range(1).select(month_key(days_before(as_of, days))).first()[0]
    for run in files.names(spark, path):
        if run.startswith(f"{RUN}="):
            for month in files.names(spark, f"{path}/{run}"):
                if month.startswith(f"{MONTH}=") and month.split("=", 1)[1] < limit:
                    files.delete(spark, f"{path}/{run}/{month}")
            if not files.names(spark, f"{path}/{run}"):
                files.delete(spark, f"{path}/{run}")


def write_table(
    df: DataFrame,
    path: str,
    sort: tuple[str, ...] = (),
    month_of: str | None = None,
    mode: str = "overwrite",
) -> None:
    """A mart table. Facts get one folder per month of ``month_of``: the rebalance hint brings a
    month's rows together yet splits the large months, so files end up of even size."""
    if month_of is None:
        (df.sortWithinPartitions(*sort) if sort else df).write.mode(mode).parquet(path)
        return
    monthly = df.withColumn(MONTH, month_key(F.col(month_of))).hint("rebalance", F.col(MONTH))
    monthly.sortWithinPartitions(MONTH, *sort).write.mode(mode).partitionBy(MONTH).parquet(path)


def write_months(df: DataFrame, path: str, month_of: str) -> None:
    """Replace only the months present in ``df``; running it again gives the same table."""
    monthly = df.withColumn(MONTH, month_key(F.col(month_of))).hint("rebalance", F.col(MONTH))
    monthly.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        MONTH
    ).parquet(path)


def list_tables(spark: SparkSession, base: str, exclude: str = "mv_") -> list[str]:
    """Names of the table folders under ``base``, without those starting with ``exclude`` and
    without the key tables kept beside others."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(base)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = {s.getPath().getName() for s in found if s.isDirectory()}
    own = {n for n in names if not n.startswith((exclude, "_", "."))}
    return sorted(n for n in own if n.removesuffix("_keys") == n or n.removesuffix("_keys") not in own)


def register_catalog(spark: SparkSession, base: str, exclude: str = "mv_") -> list[str]:
    """A view per stored table, so that they can be queried by name."""
    names, committed = list_tables(spark, base, exclude), Snapshot(spark, base)
    for name in names:
        table = committed.read(name) if name in committed else spark.read.parquet(f"{base}/{name}")
        table.createOrReplaceTempView(name)
    return names


def read_jdbc(
    spark: SparkSession,
    url: str,
    table_or_query: str,
    properties: Mapping[str, str] | None = None,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A JDBC table, or the result of a query the database runs.

    ``column`` with bounds splits the read into parallel range scans.
    """
    text = table_or_query.strip()
    table = f"({text}) AS query_result" if text.lower().startswith(("select", "with")) else text
    if column is None:
        return unqualify(spark.read.jdbc(url, table, properties=dict(properties or {})))
    return unqualify(
        spark.read.jdbc(
            url,
            table,
            column=column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=partitions,
            properties=dict(properties or {}),
        )
    )


def unqualify(df: DataFrame) -> DataFrame:
    """``alias.column`` names reduced to ``column``."""
    return df.toDF(*(c.rsplit(".", 1)[-1] for c in df.columns))
