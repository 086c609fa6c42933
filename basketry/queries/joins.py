"""Lookups, newest rows, unions and reference values over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.clean import clean_text
from basketry.operators.dedup import distinct_labels, latest_by_key, union_sources, upsert_latest
from basketry.operators.lookup import lookup
from basketry.plans import features
from basketry.queries import matrix
from basketry.queries.registry import Source, query


@query(
    "dim_customers_join",
    """
    SELECT c_custkey, a.n_name AS shop_city, b.n_name AS home_city
    FROM customer
    LEFT JOIN nation a ON c_nationkey = a.n_nationkey
    LEFT JOIN nation b ON c_custkey % 30 = b.n_nationkey AND b.n_regionkey = c_nationkey % 5
    """,
)
def dim_customers_join(t: Source) -> DataFrame:
    key = F.col("c_custkey")
    shop = lookup(
        t.customer, t.nation, [(F.col("c_nationkey"), "n_nationkey")], {"n_name": "shop_city"}
    )
    both = lookup(
        shop,
        t.nation,
        [(key % 30, "n_nationkey"), (F.col("c_nationkey") % 5, "n_regionkey")],
        {"n_name": "home_city"},
    )
    return both.select("c_custkey", "shop_city", "home_city")


@query(
    "dim_stores_join",
    """
    SELECT s_suppkey, lower(n_name) AS city, lower(r_name) AS network
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
    """,
)
def dim_stores_join(t: Source) -> DataFrame:
    placed = lookup(
        t.supplier,
        t.nation,
        [(F.col("s_nationkey"), "n_nationkey")],
        {"n_name": "city", "n_regionkey": "regionkey"},
    )
    networked = lookup(
        placed, t.region, [(F.col("regionkey"), "r_regionkey")], {"r_name": "network"}
    )
    return networked.select(
        "s_suppkey",
        clean_text(F.col("city")).alias("city"),
        clean_text(F.col("network")).alias("network"),
    )


_SPOTS = """
    WITH o AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS p,
                      nullif(o_orderstatus, 'P') AS s FROM orders),
         spots AS (SELECT p, s, count(*) AS n FROM o GROUP BY ALL)
    SELECT o_orderkey, n AS spot_size FROM o LEFT JOIN spots
"""


def _spots(t: Source, null_safe: bool) -> DataFrame:
    orders = t.orders.select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"),
        F.nullif("o_orderstatus", F.lit("P")).alias("s"),
    )
    spots = orders.groupBy("p", "s").agg(F.count(F.lit(1)).alias("n"))
    on = [(F.col("p"), "p"), (F.col("s"), "s")]
    return lookup(orders, spots, on, {"n": "spot_size"}, null_safe=null_safe).select(
        "o_orderkey", "spot_size"
    )


@query(
    "null_safe_join",
    _SPOTS + "ON o.p IS NOT DISTINCT FROM spots.p AND o.s IS NOT DISTINCT FROM spots.s",
)
def null_safe_join(t: Source) -> DataFrame:
    return _spots(t, null_safe=True)


@query("fact_address_join", _SPOTS + "ON o.p = spots.p AND o.s = spots.s")
def fact_address_join(t: Source) -> DataFrame:
    return _spots(t, null_safe=False)


@query(
    "lookup_preferred_match",
    """
    SELECT o_orderkey, line AS preferred_line, l_suppkey AS preferred_supplier
    FROM orders LEFT JOIN (
        SELECT l_orderkey, l_linenumber AS line, l_suppkey,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY (l_returnflag = 'N') DESC,
                   l_shipdate DESC, l_linenumber DESC, l_suppkey DESC) AS rn
        FROM lineitem) ON o_orderkey = l_orderkey AND rn = 1
    """,
)
def lookup_preferred_match(t: Source) -> DataFrame:
    prefer = [F.col("l_returnflag") == "N", F.col("l_shipdate")]
    found = lookup(
        t.orders.select("o_orderkey"),
        t.lineitem,
        [(F.col("o_orderkey"), "l_orderkey")],
        {"l_linenumber": "preferred_line", "l_suppkey": "preferred_supplier"},
        unique=False,
        prefer=[*prefer, F.col("l_linenumber"), F.col("l_suppkey")],
    )
    return found.select("o_orderkey", "preferred_line", "preferred_supplier")


_LINE_ORDER = """l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
    l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"""
_LINE_KEYS = ("l_orderkey", "l_linenumber")
_LINE = (
    "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)


def _lines(t: Source) -> DataFrame:
    return t.lineitem.select(*_LINE)


@query(
    "latest_row_per_key",
    f"""
    SELECT {", ".join(_LINE)} FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                     ORDER BY {_LINE_ORDER}) AS rn FROM lineitem)
    WHERE rn = 1
    """,
)
def latest_row_per_key(t: Source) -> DataFrame:
    return latest_by_key(_lines(t), _LINE_KEYS, "l_shipdate")


@query(
    "upsert_latest",
    f"""
    SELECT {", ".join(_LINE)} FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                     ORDER BY {_LINE_ORDER}) AS rn FROM lineitem)
    WHERE rn = 1
    """,
)
def upsert_two_batches(t: Source) -> DataFrame:
    """A stored table, a batch that overlaps it, and that batch once more."""
    lines = _lines(t)
    stored = latest_by_key(
        lines.filter(F.col("l_returnflag") != "R"), _LINE_KEYS, "l_shipdate"
    )
    batch = lines.filter(F.col("l_returnflag") != "N")
    once = upsert_latest(stored, batch, _LINE_KEYS, "l_shipdate")
    return upsert_latest(once, batch, _LINE_KEYS, "l_shipdate")


@query(
    "addresses_union",
    """
    SELECT country, city, spot, max(seen) AS seen FROM (
        SELECT r_name AS country, n_name AS city, c_mktsegment AS spot, c_custkey AS seen
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        UNION ALL
        SELECT r_name, n_name, NULL, s_suppkey
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey)
    GROUP BY ALL
    """,
)
def addresses_union(t: Source) -> DataFrame:
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("r_name").alias("country"), F.col("n_name").alias("city")
    )
    people = t.customer.select(
        F.col("c_nationkey").alias("n"),
        F.col("c_mktsegment").alias("spot"),
        F.col("c_custkey").alias("seen"),
    )
    shops = t.supplier.select(
        F.col("s_nationkey").alias("n"),
        F.lit(None).cast("string").alias("spot"),
        F.col("s_suppkey").alias("seen"),
    )
    both = union_sources(people, shops).join(nations, F.col("n") == F.col("n_nationkey"))
    rows = both.select("country", "city", "spot", "seen")
    return latest_by_key(rows, ("country", "city", "spot"), "seen")


@query(
    "ref_distinct_labels",
    "SELECT p_brand AS label, max(p_partkey) AS seen FROM part GROUP BY 1",
)
def ref_distinct_labels(t: Source) -> DataFrame:
    rows = t.part.select(F.col("p_brand").alias("label"), F.col("p_partkey").alias("seen"))
    return distinct_labels(rows, "label", "seen")


@query(
    "item_facts",
    """
    SELECT c_mktsegment AS segment, p_type AS category_name, count(l_orderkey) AS n_items,
           count(DISTINCT o_orderkey) AS n_purchases
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
    GROUP BY ALL
    """,
)
def item_facts(t: Source) -> DataFrame:
    facts = features.item_facts(
        matrix.purchases(t).select("purchase_id", "customer_id"),
        matrix.items(t, "l_orderkey"),
        matrix.products(t),
        matrix.categories(t),
    )
    # Per customer first, so that a customer with very many purchases meets the join small.
    per_customer = facts.groupBy("customer_id", "category_name").agg(
        F.count("l_orderkey").alias("items"), F.count_distinct("purchase_id").alias("purchases")
    )
    people = t.customer.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment")
    )
    return (
        people.join(per_customer, "customer_id", "left")
        .groupBy("segment", "category_name")
        .agg(
            F.coalesce(F.sum("items"), F.lit(0)).alias("n_items"),
            F.coalesce(F.sum("purchases"), F.lit(0)).alias("n_purchases"),
        )
    )


@query(
    "store_city",
    """
    SELECT l_orderkey, l_linenumber, n_name AS city,
           (min(s_nationkey) OVER (PARTITION BY n_name) = s_nationkey)::INT AS numbered
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation ON s_nationkey = n_nationkey
    """,
)
def store_city(t: Source) -> DataFrame:
    lines = t.lineitem.withColumnRenamed("l_suppkey", "store_id")
    placed = features.store_city(lines, matrix.stores(t), matrix.addresses(t))
    city = placed.join(
        matrix.addresses(t).select("city", F.col("address_id").alias("known")), "city", "left"
    )
    return city.select(
        "l_orderkey",
        "l_linenumber",
        "city",
        (F.col("city_no") == F.col("known")).cast("int").alias("numbered"),
    )
