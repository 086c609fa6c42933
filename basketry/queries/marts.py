"""Every mart table, built from documents made of the given tables.

Surrogate keys are hashes of this engine, so results show what a key points to instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.flatten import flatten
from basketry.plans import marts as build
from basketry.queries import retail
from basketry.queries.registry import Source, query
from basketry.session import scratch_dir
from basketry.sources.envelopes import split_valid, to_envelope


def _addresses(t: Source) -> DataFrame:
    return build.addresses(retail.raw(t, "customers"), retail.raw(t, "stores"))


def _stored(t: Source, df: DataFrame) -> DataFrame:
    """A reference table as later steps see it: written, then read back with a known size."""
    path = scratch_dir(t.spark, "reference")
    df.write.parquet(path)
    return t.spark.read.parquet(path)


def _streets(addresses: DataFrame, key: str, name: str) -> DataFrame:
    return addresses.select(F.col("address_id").alias(key), F.col("street").alias(name))


_PLACES = "nation ON {key} = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query(
    "mart_addresses",
    f"""
    SELECT lower(r_name) AS country, lower(n_name) AS city, lower(c_mktsegment) || ' lane' AS street,
           (c_custkey % 50)::VARCHAR AS house, c_custkey::VARCHAR AS apartment,
           lpad(c_custkey::VARCHAR, 6, '0') AS postal_code, c_nationkey::DOUBLE AS latitude,
           (-c_nationkey)::DOUBLE AS longitude
    FROM customer JOIN {_PLACES.format(key="c_nationkey")}
    UNION
    SELECT lower(r_name), lower(n_name), 'main street ' || s_nationkey, s_nationkey::VARCHAR, NULL,
           lpad(s_nationkey::VARCHAR, 6, '0'), s_nationkey::DOUBLE, (-s_nationkey)::DOUBLE
    FROM supplier JOIN {_PLACES.format(key="s_nationkey")}
    """,
)
def mart_addresses(t: Source) -> DataFrame:
    return _addresses(t).drop("address_id", "event_time")


@query("mart_categories", "SELECT DISTINCT 'группа ' || (p_size % 6) AS category_name FROM part")
def mart_categories(t: Source) -> DataFrame:
    return build.categories(retail.raw(t, "products")).select("category_name")


@query(
    "mart_manufacturers",
    """
    SELECT DISTINCT regexp_replace(p_brand, '[^0-9]', '', 'g') AS inn,
           lower(p_brand) AS manufacturer_name, 'country' AS manufacturer_country,
           'https://' || lower(p_brand) AS manufacturer_website
    FROM part WHERE p_size % 7 <> 0
    """,
)
def mart_manufacturers(t: Source) -> DataFrame:
    return build.manufacturers(retail.raw(t, "products")).drop("event_time")


@query(
    "mart_store_networks",
    f"""
    SELECT DISTINCT lower(r_name) AS store_network_name
    FROM supplier JOIN {_PLACES.format(key="s_nationkey")}
    """,
)
def mart_store_networks(t: Source) -> DataFrame:
    return build.store_networks(retail.raw(t, "stores")).select("store_network_name")


@query(
    "mart_store_managers",
    """
    SELECT DISTINCT lower(s_name) AS manager_name,
           md5('+7900' || lpad(s_suppkey::VARCHAR, 7, '0')) AS manager_phone,
           md5(lower(s_name) || '@example.org') AS manager_email
    FROM supplier
    """,
)
def mart_store_managers(t: Source) -> DataFrame:
    return build.store_managers(retail.raw(t, "stores")).drop("manager_id", "event_time")


@query(
    "mart_dim_customers",
    """
    SELECT 'cus-' || c_custkey AS customer_id, lower(c_name) AS first_name,
           lower(nullif(c_mktsegment, 'BUILDING')) AS last_name,
           md5(lower(c_name || '@example.com')) AS email,
           md5('+7' || lpad(c_custkey::VARCHAR, 10, '9')) AS phone,
           DATE '1990-01-01' + (c_custkey * 7 % 8000)::INT AS birth_date,
           CASE c_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' END AS gender,
           '2001-01-01 10:00' AS registered, (c_mktsegment = 'BUILDING')::INT AS is_loyalty_member,
           'loyal-' || c_custkey AS loyalty_card_number, 'en' AS preferred_language,
           'cash' AS preferred_payment_method, 0 AS receive_promotions,
           CASE WHEN c_nationkey IN (SELECT s_nationkey FROM supplier)
                THEN 'main street ' || c_nationkey END AS shop_street,
           lower(c_mktsegment) || ' lane' AS home_street
    FROM customer
    WHERE DATE '2001-01-01' > DATE '1990-01-01' + (c_custkey * 7 % 8000)::INT
    """,
)
def mart_dim_customers(t: Source) -> DataFrame:
    addresses = _stored(t, _addresses(t))
    rows = build.dim_customers(retail.raw(t, "customers"), addresses)
    return (
        rows.join(_streets(addresses, "address_id", "shop_street"), "address_id", "left")
        .join(
            _streets(addresses, "delivery_address_id", "home_street"),
            "delivery_address_id",
            "left",
        )
        .select(
            "customer_id",
            "first_name",
            "last_name",
            "email",
            "phone",
            "birth_date",
            "gender",
            F.date_format("registration_date", "yyyy-MM-dd HH:mm").alias("registered"),
            F.col("is_loyalty_member").cast("int").alias("is_loyalty_member"),
            "loyalty_card_number",
            "preferred_language",
            "preferred_payment_method",
            F.col("receive_promotions").cast("int").alias("receive_promotions"),
            "shop_street",
            "home_street",
        )
    )


@query(
    "mart_dim_products",
    """
    SELECT 'prd-' || p_partkey AS product_id, lower(p_name) AS name,
           lower(p_name || '  ' || p_brand) AS description, 'группа ' || (p_size % 6) AS category_name,
           (p_size / 2)::DOUBLE AS calories, (p_size / 4)::DOUBLE AS protein,
           (p_size / 8)::DOUBLE AS fat, p_size::DOUBLE AS carbohydrates,
           p_retailprice::DECIMAL(16,2) AS price, 'pcs' AS unit, 'country' AS origin_country,
           p_size AS expiry_days, (p_size <= 10)::INT AS is_organic,
           p_partkey::VARCHAR AS barcode,
           CASE WHEN p_size % 7 <> 0 THEN regexp_replace(p_brand, '[^0-9]', '', 'g') END
               AS manufacturer_id
    FROM part
    """,
)
def mart_dim_products(t: Source) -> DataFrame:
    raw = retail.raw(t, "products")
    categories = _stored(t, build.categories(raw))
    rows = build.dim_products(raw, _stored(t, build.manufacturers(raw)), categories)
    named = rows.join(categories.select("category_id", "category_name"), "category_id", "left")
    return named.select(
        "product_id",
        "name",
        "description",
        "category_name",
        *(F.col(c).cast("double").alias(c) for c in ("calories", "protein", "fat")),
        F.col("carbohydrates").cast("double").alias("carbohydrates"),
        "price",
        "unit",
        "origin_country",
        F.col("expiry_days").cast("int").alias("expiry_days"),
        F.col("is_organic").cast("int").alias("is_organic"),
        "barcode",
        "manufacturer_id",
    )


@query(
    "mart_dim_stores",
    f"""
    SELECT 'store-' || s_suppkey AS store_id, lower(s_name) AS store_name,
           lower(r_name) AS network, lower(s_name) AS manager,
           'main street ' || s_nationkey AS street, '09:00-21:00' AS opening_hours_mon_fri,
           (s_suppkey % 2 = 0)::INT AS accepts_online_orders,
           (s_suppkey % 3 = 0)::INT AS delivery_available, 1 AS warehouse_connected,
           DATE '2024-01-31' AS last_inventory_date
    FROM supplier JOIN {_PLACES.format(key="s_nationkey")}
    """,
)
def mart_dim_stores(t: Source) -> DataFrame:
    raw = retail.raw(t, "stores")
    networks = _stored(t, build.store_networks(raw))
    managers = _stored(t, build.store_managers(raw))
    addresses = _stored(t, _addresses(t))
    rows = build.dim_stores(raw, networks, managers, addresses)
    flags = ("accepts_online_orders", "delivery_available", "warehouse_connected")
    return (
        rows.join(
            networks.select("store_network_id", F.col("store_network_name").alias("network")),
            "store_network_id",
            "left",
        )
        .join(
            managers.select("manager_id", F.col("manager_name").alias("manager")),
            "manager_id",
            "left",
        )
        .join(_streets(addresses, "address_id", "street"), "address_id", "left")
        .select(
            "store_id",
            "store_name",
            "network",
            "manager",
            "street",
            "opening_hours_mon_fri",
            *(F.col(c).cast("int").alias(c) for c in flags),
            "last_inventory_date",
        )
    )


@query(
    "mart_store_categories",
    """
    SELECT 'store-' || s_suppkey AS store_id, unnest(CASE WHEN s_nationkey % 2 = 0
               THEN ['группа 1', 'группа 3', 'группа 5'] ELSE ['группа 1', 'unknown'] END) AS category
    FROM supplier
    """,
)
def mart_store_categories(t: Source) -> DataFrame:
    categories = _stored(t, build.categories(retail.raw(t, "products")))
    pairs = build.store_categories(retail.raw(t, "stores"), categories)
    return pairs.join(
        categories.select("category_id", "category_name"), "category_id", "left"
    ).select("store_id", F.coalesce("category_name", F.lit("unknown")).alias("category"))


@query(
    "store_labels_from_list",
    """
    SELECT 'store-' || s_suppkey AS store_id, unnest(CASE WHEN 'Brand#1' || (s_nationkey % 5 + 1) IN (SELECT p_brand FROM part)
               THEN ['brand#1' || (s_nationkey % 5 + 1), 'unknown'] ELSE ['unknown'] END) AS category
    FROM supplier
    """,
)
def store_labels_from_list(t: Source) -> DataFrame:
    """Labels with signs that the joined text could not be cut at, out of the list in RAW."""

    def raw(docs: DataFrame, topic: str) -> DataFrame:
        good, _ = split_valid(to_envelope(docs, topic, retail.RUN), topic)
        return flatten(good, topic, keep_json=False)

    products = retail.products(t).withColumn("group", F.element_at(F.split("description", "🥖 "), -1))
    label = F.concat(F.lit("🥖 "), F.concat(F.lit("Brand#1"), F.regexp_extract("location.house", "[0-9]+", 0).cast("int") % 5 + 1))
    stores = retail.stores(t).withColumn("categories", F.array(label, F.lit("semi-finished, ready-to-cook")))
    categories = _stored(t, build.categories(raw(products, "products")))
    pairs = build.store_categories(raw(stores, "stores"), categories)
    return pairs.join(
        categories.select("category_id", "category_name"), "category_id", "left"
    ).select("store_id", F.coalesce("category_name", F.lit("unknown")).alias("category"))


FACT_PURCHASES = """
    SELECT purchase_id, customer_id, store_id, total_amount, payment_method, is_delivery,
           delivery_street, day
    FROM (SELECT 'ord-' || o_orderkey AS purchase_id, 'cus-' || o_custkey AS customer_id,
                 'store-' || l_suppkey AS store_id, o_totalprice::DECIMAL(16,2) AS total_amount,
                 CASE o_orderstatus WHEN 'F' THEN 'cash' WHEN 'O' THEN 'card' END
                     AS payment_method,
                 (o_orderpriority IN ('1-URGENT', '2-HIGH'))::INT AS is_delivery,
                 CASE WHEN o_orderstatus <> 'P' THEN lower(c_mktsegment) || ' lane' END
                     AS delivery_street,
                 strftime(o_orderdate, '%Y-%m-%d') AS day,
                 row_number() OVER (PARTITION BY o_orderkey
                     ORDER BY l_shipdate DESC, 'store-' || l_suppkey DESC) AS rn
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          JOIN customer ON o_custkey = c_custkey)
    WHERE rn = 1
"""


def shown_purchases(facts: DataFrame, streets: DataFrame) -> DataFrame:
    return facts.join(streets, "delivery_address_id", "left").select(
        "purchase_id",
        "customer_id",
        "store_id",
        "total_amount",
        "payment_method",
        F.col("is_delivery").cast("int").alias("is_delivery"),
        "delivery_street",
        F.date_format("purchase_datetime", "yyyy-MM-dd").alias("day"),
    )


@query("mart_fact_purchases", FACT_PURCHASES)
def mart_fact_purchases(t: Source) -> DataFrame:
    addresses = _stored(t, _addresses(t))
    facts = build.fact_purchases(retail.raw(t, "purchases", build.PURCHASE_FIELDS), addresses)
    return shown_purchases(facts, _streets(addresses, "delivery_address_id", "delivery_street"))


@query(
    "mart_fact_purchase_items",
    """
    WITH items AS (
        SELECT 'ord-' || l_orderkey AS purchase_id, 'prd-' || l_partkey AS product_id,
               l_quantity::INT AS quantity, l_extendedprice::DECIMAL(16,2) AS total_price,
               l_shipdate FROM lineitem
        UNION ALL
        SELECT 'ord-' || l_orderkey, 'gift-' || l_suppkey, 1, 0, l_shipdate FROM lineitem)
    SELECT purchase_id, product_id, quantity, 'pcs' AS unit, total_price FROM (
        SELECT *, row_number() OVER (PARTITION BY purchase_id, product_id
            ORDER BY l_shipdate DESC, quantity DESC, total_price DESC) AS rn FROM items)
    WHERE rn = 1
    """,
)
def mart_fact_purchase_items(t: Source) -> DataFrame:
    items = build.fact_purchase_items(retail.raw(t, "purchases"))
    return items.select("purchase_id", "product_id", "quantity", "unit", "total_price")
