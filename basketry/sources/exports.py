"""CSV exports of a result."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

# Name of the exported file.
FILE_NAME = "feature_matrix_%Y-%m-%d_%H-%M-%S.csv"


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV written in parallel, to any file system incl. ``s3a://`` buckets."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_csv_single(df: DataFrame, folder: str, stamp: datetime) -> str:
    """One time-stamped CSV file with a header, replacing a file of that name.

    Only the write runs as a single task; the plan before it stays parallel.
    """
    spark = df.sparkSession
    staging, target = f"{folder}/_staging", f"{folder}/{stamp.strftime(FILE_NAME)}"
    write_csv(df.repartition(1), staging)
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    part = fs.globStatus(hadoop.Path(f"{staging}/part-*.csv"))[0].getPath()
    fs.delete(hadoop.Path(target), True)
    fs.rename(part, hadoop.Path(target))
    fs.delete(hadoop.Path(staging), True)
    return target


def export_csv(stored: DataFrame, folder: str, stamp: datetime, single: bool = False) -> str:
    """A folder with the parts written in parallel, at any size. ``single`` asks for one file
    instead, written by one task: for results known to be small."""
    if single:
        return write_csv_single(stored, folder, stamp)
    target = f"{folder}/{stamp.strftime(FILE_NAME)}"
    write_csv(stored, target)
    return target
