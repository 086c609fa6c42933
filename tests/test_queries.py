"""Every registered query against its SQL counterpart on the smallest tables."""

import datetime
import decimal
import os

import pytest
from support import TABLES, needs_tables

from basketry.queries import oracles, queries

duckdb = pytest.importorskip("duckdb")

QUERIES, ORACLES = queries(), oracles()


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for file in os.listdir(TABLES):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TABLES}/{file}'")
    return con


def plain(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def table(names, rows):
    order = [names.index(n) for n in sorted(names)]
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"duplicate_rate_approximate"}


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, database, name):
    df = QUERIES[name](spark, TABLES)
    rows = df.collect()
    assert rows
    if name in ORACLES:
        cursor = database.execute(ORACLES[name])
        names = [d[0] for d in cursor.description]
        assert sorted(df.columns) == sorted(names)
        assert table(df.columns, rows) == table(names, cursor.fetchall())


@needs_tables
@pytest.mark.parametrize("name", ["null_safe_join", "dim_customers_join", "feature_matrix"])
def test_no_nested_loop_or_cross_join(spark, name):
    plan = QUERIES[name](spark, TABLES)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@needs_tables
def test_entry(spark):
    import __spark_entry__ as entry

    matrix = entry.entry(spark)
    assert len(matrix.columns) == 34 and matrix.count() > 0
