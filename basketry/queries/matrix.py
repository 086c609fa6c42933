"""The feature matrix over the given tables.

orders play purchases, lineitem their items, part the products (its type the category),
supplier the stores (a purchase's store is the smallest of its lines), nation the city.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.plans.features import (
    Scope,
    Terms,
    assemble,
    customer_flags,
    purchase_rows,
    roll_up_items,
    with_variety,
)
from basketry.queries.registry import Source, query

TERMS = Terms(
    categories={
        "milk": "PROMO",
        "fruit": "LARGE",
        "veggies": "SMALL",
        "bakery": "ECONOMY",
        "meat": "MEDIUM",
    },
    bulk_over=300_000,
    low_cost_under=200_000,
    week_spend_over=400_000,
)


def as_of(t: Source) -> Column:
    return t.orders.agg(F.max("o_orderdate")).scalar()


def scope(t: Source, compat: bool = False) -> Scope:
    return Scope(as_of(t), TERMS, compat)


def customers(t: Source) -> DataFrame:
    age = (F.col("c_custkey") % 400).cast("int")
    return t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.concat(F.lit("LOYAL-"), F.col("c_custkey").cast("string")).alias("loyalty_card_number"),
        F.date_sub(F.lit("2001-08-01").cast("date"), age)
        .cast("timestamp_ntz")
        .alias("registration_date"),
        (F.col("c_mktsegment") == "BUILDING").alias("is_loyalty_member"),
    )


def purchases(t: Source) -> DataFrame:
    status = F.col("o_orderstatus")
    return t.orders.select(
        F.col("o_orderkey").alias("purchase_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(16,2)").alias("total_amount"),
        F.when(status == "F", "cash").when(status == "O", "card").alias("payment_method"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("is_delivery"),
        F.col("o_orderdate").alias("purchase_datetime"),
    )


def products(t: Source) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category_id"),
        (F.col("p_size") <= 10).alias("is_organic"),
    )


def categories(t: Source) -> DataFrame:
    return t.part.select(
        F.col("p_type").alias("category_id"), F.col("p_type").alias("category_name")
    ).distinct()


def items(t: Source, *more: str) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("purchase_id"), F.col("l_partkey").alias("product_id"), *more
    )


def baskets(t: Source, extra: Mapping[str, Column] | None = None) -> DataFrame:
    lines = items(t, *(("l_suppkey",) if extra else ()))
    return roll_up_items(lines, products(t), categories(t), TERMS, extra=extra)


def stores(t: Source) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("store_id"), F.col("s_nationkey").alias("address_id")
    )


def addresses(t: Source) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("address_id"), F.col("n_name").alias("city"))


def purchases_with_baskets(t: Source) -> DataFrame:
    baskets_and_store = baskets(t, {"store_id": F.min("l_suppkey")})
    return purchase_rows(purchases(t), baskets_and_store, stores(t), addresses(t))


# The SQL counterpart works at item grain with distinct counts, join by join.
ROLES = """
    WITH store AS (SELECT l_orderkey, min(l_suppkey) AS store_id, count(*) AS n_items
                   FROM lineitem GROUP BY 1),
    pu AS (SELECT o_orderkey AS purchase_id, o_custkey AS customer_id, store_id, n_items,
                  n_name AS city, o_totalprice::DECIMAL(16,2) AS total_amount,
                  CASE o_orderstatus WHEN 'F' THEN 'cash' WHEN 'O' THEN 'card' END
                      AS payment_method,
                  o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_delivery, o_orderdate AS bought_at,
                  (SELECT max(o_orderdate) FROM orders) AS now
           FROM orders LEFT JOIN store ON l_orderkey = o_orderkey
           LEFT JOIN supplier ON store_id = s_suppkey
           LEFT JOIN nation ON s_nationkey = n_nationkey),
    it AS (SELECT purchase_id, customer_id, now, bought_at,
                  CASE WHEN l_orderkey IS NOT NULL THEN bought_at END AS item_at,
                  p_type AS category, p_size <= 10 AS is_organic
           FROM pu LEFT JOIN lineitem ON l_orderkey = purchase_id
           LEFT JOIN part ON l_partkey = p_partkey)
"""

ITEM_FLAGS = {
    "bought_milk_last_30d": "max(category = 'PROMO' AND item_at BETWEEN now - INTERVAL 30 DAY AND now)",
    "bought_fruits_last_14d": "max(category = 'LARGE' AND item_at BETWEEN now - INTERVAL 14 DAY AND now)",
    "not_bought_veggies_14d": "NOT max(category = 'SMALL' AND item_at >= now - INTERVAL {veggies} DAY)",
    "organic_preference": "max(is_organic)",
    "buys_bakery": "max(category = 'ECONOMY')",
    "bought_meat_last_week": "max(category = 'MEDIUM' AND bought_at >= now - INTERVAL 7 DAY)",
    "varied_shopper": "count(DISTINCT category) >= 4",
    "fruit_lover": "count(DISTINCT CASE WHEN category = 'LARGE' AND bought_at >= now - INTERVAL 30 DAY"
    " THEN purchase_id END) >= 3",
    "vegetarian_profile": "sum(CASE WHEN category = 'MEDIUM' AND bought_at >= now - INTERVAL 90 DAY"
    " THEN 1 ELSE 0 END) = 0",
}

PURCHASE_FLAGS = {
    "recurrent_buyer": "count(CASE WHEN bought_at BETWEEN now - INTERVAL 30 DAY AND now THEN 1 END) > 2",
    "inactive_14_30": "count(CASE WHEN bought_at BETWEEN now - INTERVAL 30 DAY AND now - INTERVAL 14 DAY"
    " THEN 1 END) = 0",
    "delivery_user": "max(is_delivery)",
    "bulk_buyer": "avg(total_amount) > 300000",
    "low_cost_buyer": "avg(total_amount) < 200000",
    "loyal_customer": "count(DISTINCT purchase_id) >= 3",
    "multicity_buyer": "count(DISTINCT city) > 1",
    "night_shopper": "max(hour(bought_at) > 20)",
    "morning_shopper": "max(hour(bought_at) < 10)",
    "prefers_cash": "{cash} / nullif(count(purchase_id), 0) >= 0.7",
    "prefers_card": "{card} / nullif(count(purchase_id), 0) >= 0.7",
    "weekend_shopper": "count(CASE WHEN isodow(bought_at) >= 6 THEN 1 END)"
    " / nullif(count(purchase_id), 0) >= 0.6",
    "weekday_shopper": "count(CASE WHEN {weekday} THEN 1 END)"
    " / nullif(count(purchase_id), 0) >= 0.6",
    "single_item_buyer": "sum((n_items = 1)::INT) / nullif(count(purchase_id), 0) >= 0.5",
    "store_loyal": "count(DISTINCT store_id) = 1 AND count(purchase_id) > 0",
    "switching_store": "count(DISTINCT store_id) > 1",
    "family_shopper": "avg(n_items) >= 4",
    "early_bird": "max(hour(bought_at) BETWEEN 12 AND 14)",
    "no_purchases": "count(purchase_id) = 0",
    "recent_high_spender": "sum(CASE WHEN bought_at >= now - INTERVAL 7 DAY THEN total_amount ELSE 0 END)"
    " > 400000",
}

_RULES = {
    False: {
        "veggies": "14",
        "cash": "count(CASE WHEN payment_method = 'cash' THEN 1 END)",
        "card": "count(CASE WHEN payment_method = 'card' THEN 1 END)",
        "weekday": "isodow(bought_at) <= 5",
    },
    True: {
        "veggies": "30",
        "cash": "count(payment_method = 'cash')",
        "card": "count(payment_method = 'card')",
        "weekday": "dayofweek(bought_at) BETWEEN 0 AND 4",
    },
}
_WITHOUT = {"inactive_14_30": 1, "no_purchases": 1, "vegetarian_profile": 1}


def _flag_list(flags: Mapping[str, str], compat: bool) -> str:
    return ", ".join(f"({sql.format(**_RULES[compat])})::INT AS {n}" for n, sql in flags.items())


def _oracle(compat: bool) -> str:
    names = [n for n in (*ITEM_FLAGS, *PURCHASE_FLAGS) if n != "loyal_customer"]
    flags = ", ".join(f"coalesce({n}, {_WITHOUT.get(n, 0)}) AS {n}" for n in names)
    return f"""{ROLES}
    , by_item AS (SELECT customer_id, {_flag_list(ITEM_FLAGS, compat)} FROM it GROUP BY 1)
    , by_purchase AS (SELECT customer_id, {_flag_list(PURCHASE_FLAGS, compat)} FROM pu GROUP BY 1)
    SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name,
           'LOYAL-' || c_custkey AS loyalty_card_number, {flags},
           (c_mktsegment = 'BUILDING' AND coalesce(loyal_customer, 0) = 1)::INT AS loyal_customer,
           (DATE '2001-08-01' - (c_custkey % 400)::INT
               BETWEEN (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY
                   AND (SELECT max(o_orderdate) FROM orders))::INT AS new_customer
    FROM customer LEFT JOIN by_item i ON c_custkey = i.customer_id
    LEFT JOIN by_purchase p ON c_custkey = p.customer_id
    """


def varied(t: Source, flags: DataFrame) -> DataFrame:
    """The roll-up with the flag that counts distinct categories, for any number of these."""
    return with_variety(flags, purchases(t), items(t), products(t), categories(t))


def _matrix(t: Source, compat: bool) -> DataFrame:
    s = scope(t, compat)
    flags = varied(t, customer_flags(purchases_with_baskets(t), s))
    return assemble(customers(t), flags, s.as_of)


@query("feature_matrix", _oracle(compat=False))
def matrix(t: Source) -> DataFrame:
    return _matrix(t, compat=False)


@query("feature_matrix_compat", _oracle(compat=True))
def matrix_compat(t: Source) -> DataFrame:
    return _matrix(t, compat=True)
