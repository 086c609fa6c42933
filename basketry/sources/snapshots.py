"""Stored tables in parts, changed part by part and committed together.

Every part (a month, or a bucket of keys) lies in a folder of its own that is never changed. A
commit writes the parts it touches to new folders and then one small file, ``_snapshots/<n>.json``,
with the folder, the row versions and the schema of every table's parts. Readers take the newest
such file, so they see all tables before a commit or all of them after it, and a run that dies on
the way leaves every table as it was. Removing a part only leaves it out of the next file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.dates import Moment, days_before, month_key
from basketry.operators.dedup import latest_by_key, union_sources
from basketry.schemas import VERSION
from basketry.sources import files

PART = "part"
BUCKETS = 8
_KEY = "key"


def bucket(cols: Sequence[str], buckets: int = BUCKETS) -> Column:
    """A part by a hash of the columns; NULL and blank fall together, as keys still tell them apart."""
    texts = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols)
    return F.pmod(F.xxhash64(*texts), F.lit(buckets)).cast("string")


class Snapshot:
    """The tables under ``base`` as of the newest commit, and the changes made to them since.

    Changes are seen by this object alone until ``commit``.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        found = [n for n in files.names(spark, f"{base}/_snapshots") if n.endswith(".json") and n[0] != "_"]
        self.version = int(found[-1].split(".")[0]) if found else 0
        self.tables: dict[str, dict] = json.loads(files.read_text(spark, f"{base}/_snapshots/{found[-1]}")) if found else {}
        self.written: list[str] = []
        self._folder = f"c={self.version + 1:08d}-{uuid.uuid4().hex[:8]}"

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def parts(self, name: str) -> dict[str, dict]:
        return self.tables[name]["parts"] if name in self.tables else {}

    def read(self, name: str, parts: Iterable[str] | None = None) -> DataFrame | None:
        """A table, or only some of its parts; None where there is no such table."""
        if name not in self.tables:
            return None
        schema = T.StructType.fromJson(self.tables[name]["schema"])
        own = self.parts(name)
        wanted = own if parts is None else [p for p in parts if p in own]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.base}/{own[p]['folder']}" for p in wanted))

    def replace(self, name: str, rows: DataFrame, part: Column, touched: Iterable[str] | None = None, version: str = VERSION) -> None:
        """Put ``rows`` in the place of the touched parts (of all parts if None is given).

        The rebalance hint brings a part's rows together yet splits the large ones.
        """
        schema = rows.schema
        folder = f"{name}/{self._folder}-{len(self.written)}"
        placed = rows.withColumn(PART, part).hint("rebalance", F.col(PART))
        placed.write.mode("overwrite").partitionBy(PART).parquet(f"{self.base}/{folder}")
        self.written.append(folder)
        old = self.parts(name)
        kept = {} if touched is None else {p: x for p, x in old.items() if p not in set(touched)}
        new = [n.split("=", 1)[1] for n in files.names(self.spark, f"{self.base}/{folder}") if n.startswith(f"{PART}=")]
        found = {p: {"folder": f"{folder}/{PART}={p}"} for p in new}
        if new and version in schema.names:
            stored = self.spark.read.schema(T.StructType([schema[version], T.StructField(PART, T.StringType())])).parquet(f"{self.base}/{folder}")
            micros = F.unix_micros(F.col(version).cast("timestamp"))
            for r in stored.groupBy(PART).agg(F.min(micros).alias("oldest"), F.max(micros).alias("newest")).collect():
                found[r[PART]] |= {"oldest": r["oldest"], "newest": r["newest"]}
        if overlap := kept.keys() & found.keys():
            raise ValueError(f"{name}: rows of parts that were not to be replaced: {sorted(overlap)}")
        self.tables[name] = {"schema": json.loads(schema.json()), "parts": kept | found}

    def merge(self, name: str, rows: DataFrame, keys: Sequence[str], month_of: str | None = None, by: Sequence[str] | None = None) -> None:
        """Merge a slice, newest row per key; only the parts that the slice touches are read and
        written.

        Parts are the months of ``month_of``, else buckets of ``by``, which is some of the keys.
        Where the month is no part of the key, a second table holds the key hashes of every month,
        so a row that moves to another month leaves its old one.
        """
        part = month_key(F.col(month_of)) if month_of else bucket(by or keys)
        part = F.coalesce(part, F.lit("none"))
        moving = month_of is not None and month_of not in keys
        index, hashed = f"{name}_keys", F.xxhash64(*(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
        if name not in self:
            self.replace(name, latest_by_key(rows, keys), part)
            if moving:
                self._reindex(name, index, hashed, part, None)
            return
        touched = {r[0] for r in rows.select(part).distinct().collect()}
        if moving:
            own = rows.select(hashed.alias(_KEY)).distinct()
            touched |= {r[0] for r in self.read(index).join(own, _KEY, "left_semi").select("month").distinct().collect()}
        if not touched:
            return
        both = union_sources(self.read(name, touched), rows.select(self.read(name, ()).columns))
        self.replace(name, latest_by_key(both, keys), part, touched)
        if moving:
            self._reindex(name, index, hashed, part, touched)

    def _reindex(self, name: str, index: str, hashed: Column, part: Column, touched: Iterable[str] | None) -> None:
        rows = self.read(name, touched).select(hashed.alias(_KEY), part.alias("month"))
        self.replace(index, rows, F.col("month"), touched)

    def expire(self, name: str, days: int, as_of: Moment, month_of: str | None = None, version: str = VERSION) -> None:
        """Remove rows older than ``days``. Parts that are older as a whole are left out unread;
        only those that hold rows on either side of the limit are written again."""
        if name not in self:
            return
        limit = self.spark.range(1).select(F.unix_micros(days_before(as_of, days).cast("timestamp"))).first()[0]
        parts = self.parts(name)
        gone = [p for p, x in parts.items() if x.get("newest") is not None and x["newest"] < limit]
        border = [p for p, x in parts.items() if p not in gone and x.get("oldest") is not None and x["oldest"] < limit]
        for table in (name, f"{name}_keys"):
            for p in gone:
                self.parts(table).pop(p, None)
        for p in border:
            rows = self.read(name, [p])
            self.replace(name, rows.filter(F.unix_micros(F.col(version).cast("timestamp")) >= limit), F.lit(p), [p], version)

    def commit(self) -> None:
        """Make the changes the tables' state for everyone."""
        self.version += 1
        files.write_text(self.spark, f"{self.base}/_snapshots/{self.version:08d}.json", json.dumps(self.tables))
        self.written = []
        self._folder = f"c={self.version + 1:08d}-{uuid.uuid4().hex[:8]}"

    def vacuum(self, keep: int = 2) -> None:
        """Delete the folders that none of the newest ``keep`` commits names, and older commits."""
        found = [n for n in files.names(self.spark, f"{self.base}/_snapshots") if n.endswith(".json") and n[0] != "_"]
        used = set()
        for n in found[-keep:]:
            tables = json.loads(files.read_text(self.spark, f"{self.base}/_snapshots/{n}"))
            used |= {x["folder"] for t in tables.values() for x in t["parts"].values()}
        for n in found[:-keep]:
            files.delete(self.spark, f"{self.base}/_snapshots/{n}")
        for name in self.tables:
            for commit in files.names(self.spark, f"{self.base}/{name}"):
                if f"{name}/{commit}" in self.written:
                    continue
                for p in files.names(self.spark, f"{self.base}/{name}/{commit}"):
                    if p.startswith(f"{PART}=") and f"{name}/{commit}/{p}" not in used:
                        files.delete(self.spark, f"{self.base}/{name}/{commit}/{p}")
                if not any(f.startswith(f"{name}/{commit}/") for f in used):
                    files.delete(self.spark, f"{self.base}/{name}/{commit}")


def read_snapshot(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table as of the newest commit."""
    found = Snapshot(spark, base).read(name)
    if found is None:
        raise ValueError(f"no table {name} under {base}")
    return found
