"""The register of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[["Source"], DataFrame]

_QUERIES: dict[str, tuple[Query, str | None]] = {}
_MODULES = ("cleaning", "ingest", "joins", "flags", "matrix", "marts", "quality", "store", "streams")


class Source:
    """The given tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, table: str) -> DataFrame:
        if table.startswith("_"):
            raise AttributeError(table)
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")


class Slice(Source):
    """The given tables, some with one of ``of`` shares of their rows only, dealt by a whole-number key.

    Rows of equal keys are in the slice of the same number, in whichever table.
    """

    def __init__(self, whole: Source, keys: Mapping[str, str], number: int, of: int):
        super().__init__(whole.spark, whole.folder)
        self.keys, self.number, self.of = keys, number, of

    def __getattr__(self, table: str) -> DataFrame:
        rows = super().__getattr__(table)
        if table not in self.keys:
            return rows
        share = F.pmod(F.xxhash64(F.col(self.keys[table]).cast("bigint")), F.lit(self.of))
        return rows.filter(share == self.number)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        _QUERIES[name] = (function, sql)
        return function

    return register


def _loaded() -> dict[str, tuple[Query, str | None]]:
    for module in _MODULES:
        import_module(f"basketry.queries.{module}")
    return _QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: function(Source(spark, folder))

    return {name: bind(function) for name, (function, _) in _loaded().items()}


def oracles() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _loaded().items() if sql}
