"""The registered flag queries over more product types than fit the category masks."""

import os
import shutil

import pytest
from support import TABLES, needs_tables
from pyspark.sql import functions as F

from basketry.queries import queries


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """The given tables with 300 product types."""
    base = str(tmp_path_factory.mktemp("many"))
    for name in ("customer", "orders", "lineitem", "supplier", "nation"):
        source, target = f"{TABLES}/{name}.parquet", f"{base}/{name}.parquet"
        (shutil.copytree if os.path.isdir(source) else shutil.copy)(source, target)
    part = spark.read.parquet(f"{TABLES}/part.parquet")
    types = F.concat(F.lit("T"), (F.col("p_partkey") % 300).cast("string"))
    extra = spark.range(300).select(*(F.lit(None).cast(f.dataType).alias(f.name) if f.name != "p_partkey" else (F.col("id") + 10**6).cast(f.dataType).alias(f.name) for f in part.schema))
    part.unionByName(extra).withColumn("p_type", types).write.parquet(f"{base}/part.parquet")
    return base


@needs_tables
@pytest.mark.parametrize("name", ["feature_matrix", "feature_matrix_compat", "feat_category_variety"])
def test_varied_shopper_with_300_categories(spark, many, name):
    tables = {n: spark.read.parquet(f"{many}/{n}.parquet") for n in ("orders", "lineitem", "part")}
    assert tables["part"].select("p_type").distinct().count() == 300
    joined = tables["orders"].join(tables["lineitem"], F.expr("o_orderkey = l_orderkey")).join(tables["part"], F.expr("l_partkey = p_partkey"))
    n = {r[0]: r[1] for r in joined.groupBy("o_custkey").agg(F.countDistinct("p_type")).collect()}
    found = queries()[name](spark, many).collect()
    assert found and all(r["varied_shopper"] == int(n.get(r["customer_id"], 0) >= 4) for r in found)
