"""Tables as logs of micro-batches, dealt to buckets by key and compacted by tiers.

A batch writes its rows under ``batch_id=<n>``, in a folder for each bucket; a replayed batch
replaces its own folder. Whenever ``FAN_IN`` neighbours of a tier have come together they are merged
into one folder of the next, ``batch_id=<first>-<last>``, so a log is read from a number of folders
that grows with the logarithm of the batches, and a reader that knows its keys opens their buckets
only. Merging and reading whole logs go by shares of buckets, so that what they shuffle at a time
is bounded, too. The merged folder is complete before the ones it stands for go. A reader that meets both, or
a run that dies between, sees some rows twice, which the newest row per key does not mind.
"""

from __future__ import annotations

import gc
import json
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.dedup import latest_by_key
from basketry.schemas import VERSION
from basketry.sources import files

BATCH = "batch_id"
BUCKET = "bucket"
BUCKETS = 16
FAN_IN = 8
# Stored bytes of the buckets that are merged or looked through at a time.
SHARE_BYTES = 64 * 1024 * 1024
_SCHEMA = "_schema.json"


def bucket_of(cols: Sequence[str], buckets: int = BUCKETS) -> Column:
    texts = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols)
    return F.pmod(F.xxhash64(*texts), F.lit(buckets)).cast("int")


def touched(keys: DataFrame, cols: Sequence[str]) -> list[int]:
    """The buckets that hold these keys, ``BUCKETS`` at most."""
    return [r[0] for r in keys.select(bucket_of(cols)).distinct().collect()]


def release(spark: SparkSession) -> None:
    """Have shuffle files deleted that only dead plans name: they go once the driver has collected those."""
    gc.collect()
    spark._jvm.java.lang.System.gc()


def _write(rows: DataFrame, folder: str, by: Sequence[str], mode: str) -> None:
    dealt = rows.withColumn(BUCKET, bucket_of(by)).hint("rebalance", F.col(BUCKET))
    dealt.write.mode(mode).partitionBy(BUCKET).parquet(folder, compression="zstd")


def append(rows: DataFrame, path: str, batch_id: int, by: Sequence[str], more: bool = False) -> None:
    """The rows of one batch, brought together by bucket; large buckets split into even files.

    With ``more`` they come to those that the batch has appended before.
    """
    spark = rows.sparkSession
    if not files.exists(spark, f"{path}/{_SCHEMA}"):
        files.write_text(spark, f"{path}/{_SCHEMA}", rows.schema.json())
    _write(rows, _folder(path, batch_id, batch_id), by, "append" if more else "overwrite")


def skip(spark: SparkSession, path: str, batch_id: int) -> bool:
    """Stand in for appending no rows: a replayed batch leaves none of its folder. False where the
    table is not known yet and needs the empty rows for its columns."""
    known = files.exists(spark, f"{path}/{_SCHEMA}")
    if known:
        files.delete(spark, _folder(path, batch_id, batch_id))
    return known


def spans(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """First and last batch of each folder to read, in order; folders within a merged one are not."""
    found = []
    for name in files.names(spark, path):
        if m := re.fullmatch(rf"{BATCH}=(\d+)(?:-(\d+))?", name):
            found.append((int(m[1]), int(m[2] or m[1])))
    found.sort(key=lambda x: (x[0], -x[1]))
    kept: list[tuple[int, int]] = []
    for first, last in found:
        if not kept or last > kept[-1][1]:
            kept.append((first, last))
    return kept


def _folder(path: str, first: int, last: int) -> str:
    return f"{path}/{BATCH}={first}" + (f"-{last}" if last > first else "")


def read_log(spark: SparkSession, path: str, buckets: Sequence[int] | None = None, within: Sequence[tuple[int, int]] | None = None) -> DataFrame | None:
    """All rows, of all batches or some buckets; None where nothing was ever written."""
    if not files.exists(spark, f"{path}/{_SCHEMA}"):
        return None
    schema = T.StructType.fromJson(json.loads(files.read_text(spark, f"{path}/{_SCHEMA}")))
    folders = [_folder(path, *x) for x in (spans(spark, path) if within is None else within)]
    own = None if buckets is None else {f"{BUCKET}={b}" for b in buckets}
    found = [f"{f}/{n}" for f in folders for n in files.names(spark, f) if n.startswith(f"{BUCKET}=") and (own is None or n in own)]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def shares(spark: SparkSession, path: str, buckets: Sequence[int] | None = None, within: Sequence[tuple[int, int]] | None = None) -> list[list[int]]:
    """The stored ones of the buckets, in shares of ``SHARE_BYTES`` at most or of a single bucket.
    There is one share at least."""
    stored = {b: 0 for b in range(BUCKETS)}
    for folder in (_folder(path, *x) for x in (spans(spark, path) if within is None else within)):
        for name in files.names(spark, folder):
            if m := re.fullmatch(rf"{BUCKET}=(\d+)", name):
                stored[int(m[1])] += files.size(spark, f"{folder}/{name}")
    dealt: list[list[int]] = [[]]
    room = SHARE_BYTES
    for b, size in stored.items():
        if size and (buckets is None or b in buckets):
            if dealt[-1] and size > room:
                dealt.append([])
                room = SHARE_BYTES
            dealt[-1].append(b)
            room -= size
    return dealt


def compact_log(spark: SparkSession, path: str, before: int, keys: Sequence[str], by: Sequence[str], version: str = VERSION, fan_in: int = FAN_IN, keep: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Merge neighbours of the batches before ``before`` (which may still be replayed), as often
    as a tier is full: newest row per key, only those that ``keep`` lets through.

    Shares of buckets are merged one after another. Where ``by`` has columns beyond ``keys``, a key
    may thus keep a row in each of its buckets, which the newest row per key does not mind either.
    """

    def tier(span: tuple[int, int]) -> int:
        width, level = span[1] - span[0] + 1, 0
        while width >= fan_in:
            width, level = width // fan_in, level + 1
        return level

    while True:
        due = [s for s in spans(spark, path) if s[1] < before]
        run: list[tuple[int, int]] = []
        for s in due:
            run = [*run, s] if run and tier(run[-1]) == tier(s) else [s]
            if len(run) == fan_in:
                break
        if len(run) < fan_in:
            return
        draft, whole = f"{path}/_draft", _folder(path, run[0][0], run[-1][1])
        files.delete(spark, draft)
        dealt = shares(spark, path, within=run)
        for own in dealt:
            rows = latest_by_key(read_log(spark, path, own, run), keys, version)
            _write(keep(rows) if keep else rows, draft, by, "append")
            if len(dealt) > 1:
                del rows
                release(spark)
        files.move(spark, draft, whole)
        for s in run:
            files.delete(spark, _folder(path, *s))
