"""Groups of customer flags, and the aggregates behind them, over the given tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.aggregates import (
    as_flag,
    count_where,
    ever,
    mean,
    n_distinct_where,
    never,
    one_only,
    several,
    share,
    sum_where,
)
from basketry.functions.dates import days_before, in_window
from basketry.plans.features import FLAGS, Scope, customer_flags
from basketry.queries import matrix
from basketry.queries.matrix import ITEM_FLAGS, PURCHASE_FLAGS, ROLES
from basketry.queries.registry import Source, query


def _sql(source: str, *names: str) -> str:
    all_flags = {**ITEM_FLAGS, **PURCHASE_FLAGS}
    fixed = {
        "veggies": "14",
        "cash": "count(CASE WHEN payment_method = 'cash' THEN 1 END)",
        "card": "count(CASE WHEN payment_method = 'card' THEN 1 END)",
        "weekday": "isodow(bought_at) <= 5",
    }
    flags = ", ".join(
        f"coalesce(({all_flags[n].format(**fixed)})::INT, 0) AS {n}" for n in names
    )
    return f"{ROLES} SELECT customer_id, {flags} FROM {source} GROUP BY 1"


def _flagged(rows: DataFrame, scope: Scope, names: Sequence[str]) -> DataFrame:
    return _as_flags(customer_flags(rows, scope, names), names)


def _as_flags(flags: DataFrame, names: Sequence[str]) -> DataFrame:
    return flags.select(
        "customer_id", *(F.coalesce(as_flag(F.col(n)), F.lit(0)).alias(n) for n in names)
    )


_WINDOWED = ("bought_milk_last_30d", "bought_fruits_last_14d", "bought_meat_last_week")


@query("feat_category_window", _sql("it", *_WINDOWED))
def feat_category_window(t: Source) -> DataFrame:
    rows = matrix.purchases(t).join(matrix.baskets(t), "purchase_id", "left")
    return _flagged(rows, matrix.scope(t), _WINDOWED)


_EVER = ("organic_preference", "buys_bakery")


@query("feat_ever_flags", _sql("it", *_EVER))
def feat_ever_flags(t: Source) -> DataFrame:
    rows = matrix.purchases(t).join(matrix.baskets(t), "purchase_id", "left")
    return _flagged(rows, matrix.scope(t), _EVER)


_NOT_BOUGHT = ("not_bought_veggies_14d", "vegetarian_profile")


@query("feat_not_bought", _sql("it", *_NOT_BOUGHT))
def feat_not_bought(t: Source) -> DataFrame:
    rows = matrix.purchases(t).join(matrix.baskets(t), "purchase_id", "left")
    return _flagged(rows, matrix.scope(t), _NOT_BOUGHT)


_VARIED = ("varied_shopper", "fruit_lover")


@query("feat_category_variety", _sql("it", *_VARIED))
def feat_category_variety(t: Source) -> DataFrame:
    rows = matrix.purchases(t).join(matrix.baskets(t), "purchase_id", "left")
    return _as_flags(matrix.varied(t, customer_flags(rows, matrix.scope(t), _VARIED)), _VARIED)


_COUNTS = ("recurrent_buyer", "inactive_14_30")


@query("feat_recent_counts", _sql("pu", *_COUNTS))
def feat_recent_counts(t: Source) -> DataFrame:
    return _flagged(matrix.purchases(t), matrix.scope(t), _COUNTS)


@query("feat_recent_spend", _sql("pu", "recent_high_spender"))
def feat_recent_spend(t: Source) -> DataFrame:
    return _flagged(matrix.purchases(t), matrix.scope(t), ("recent_high_spender",))


_MEANS = ("bulk_buyer", "low_cost_buyer", "delivery_user")


@query("feat_avg_basket", _sql("pu", *_MEANS))
def feat_avg_basket(t: Source) -> DataFrame:
    return _flagged(matrix.purchases(t), matrix.scope(t), _MEANS)


_PAYMENT = ("prefers_cash", "prefers_card")


@query("feat_payment_share", _sql("pu", *_PAYMENT))
def feat_payment_share(t: Source) -> DataFrame:
    return _flagged(matrix.purchases(t), matrix.scope(t), _PAYMENT)


_BASKET = ("single_item_buyer", "family_shopper")


@query("feat_basket_size", _sql("pu", *_BASKET))
def feat_basket_size(t: Source) -> DataFrame:
    sizes = t.lineitem.groupBy(F.col("l_orderkey").alias("purchase_id")).agg(
        F.count(F.lit(1)).alias("n_items")
    )
    rows = matrix.purchases(t).join(sizes, "purchase_id", "left")
    return _flagged(rows, matrix.scope(t), _BASKET)


_PLACES = ("multicity_buyer", "store_loyal", "switching_store")


@query("feat_multicity", _sql("pu", *_PLACES))
def feat_multicity(t: Source) -> DataFrame:
    return _flagged(matrix.purchases_with_baskets(t), matrix.scope(t), _PLACES)


@query(
    "feat_loyal",
    """
    SELECT c_custkey AS customer_id,
           (c_mktsegment = 'BUILDING' AND count(DISTINCT o_orderkey) >= 3)::INT AS loyal_customer,
           (count(o_orderkey) = 0)::INT AS no_purchases
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    GROUP BY c_custkey, c_mktsegment
    """,
)
def feat_loyal(t: Source) -> DataFrame:
    flags = customer_flags(matrix.purchases(t), matrix.scope(t), ("loyal_customer", "no_purchases"))
    member = F.col("is_loyalty_member") & F.col("loyal_customer")
    return (
        matrix.customers(t)
        .join(flags, "customer_id", "left")
        .select(
            "customer_id",
            F.coalesce(as_flag(member), F.lit(0)).alias("loyal_customer"),
            F.coalesce(as_flag(F.col("no_purchases")), F.lit(1)).alias("no_purchases"),
        )
    )


_TIMES = ("night_shopper", "morning_shopper", "early_bird", "weekend_shopper", "weekday_shopper")


def _visits(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("customer_id"),
        F.col("event_id").alias("purchase_id"),
        F.col("ts").alias("purchase_datetime"),
    )


def _all_customers(t: Source, flags: DataFrame, names: Sequence[str]) -> DataFrame:
    without = {f.name: f.without for f in FLAGS}
    return (
        t.customer.select(F.col("c_custkey").alias("customer_id"))
        .join(flags, "customer_id", "left")
        .select(
            "customer_id",
            *(F.coalesce(as_flag(F.col(n)), F.lit(without[n])).alias(n) for n in names),
        )
    )


_VISITS = """
    SELECT c_custkey AS customer_id, {flags}
    FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY 1
"""


@query(
    "feat_hour_flags",
    _VISITS.format(
        flags="""max(CASE WHEN hour(ts) > 20 THEN 1 ELSE 0 END) AS night_shopper,
        max(CASE WHEN hour(ts) < 10 THEN 1 ELSE 0 END) AS morning_shopper,
        max(CASE WHEN hour(ts) BETWEEN 12 AND 14 THEN 1 ELSE 0 END) AS early_bird"""
    ),
)
def feat_hour_flags(t: Source) -> DataFrame:
    flags = customer_flags(_visits(t.events), matrix.scope(t), _TIMES[:3])
    return _all_customers(t, flags, _TIMES[:3])


@query(
    "feat_weekday_share",
    """
    SELECT c_custkey AS customer_id,
           coalesce((sum(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END)
               / nullif(count(event_id), 0) >= 0.6)::INT, 0) AS weekend_shopper,
           coalesce((sum(CASE WHEN isodow(ts) <= 5 THEN 1 ELSE 0 END)
               / nullif(count(event_id), 0) >= 0.6)::INT, 0) AS weekday_shopper
    FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY 1
    """,
)
def feat_weekday_share(t: Source) -> DataFrame:
    flags = customer_flags(_visits(t.events), matrix.scope(t), _TIMES[3:])
    return _all_customers(t, flags, _TIMES[3:])


@query(
    "feat_new_customer",
    """
    SELECT o_custkey AS customer_id,
           CASE WHEN min(o_orderdate) BETWEEN TIMESTAMP '1995-06-01' - INTERVAL 30 DAY
                                          AND TIMESTAMP '1995-06-01' THEN 1 ELSE 0 END
               AS new_customer
    FROM orders GROUP BY 1
    """,
)
def feat_new_customer(t: Source) -> DataFrame:
    first = t.orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.min("o_orderdate").alias("registration_date")
    )
    moment = F.lit("1995-06-01").cast("timestamp_ntz")
    recent = in_window(F.col("registration_date"), moment, 30)
    return first.select("customer_id", F.when(recent, 1).otherwise(0).alias("new_customer"))


@query(
    "feat_distinct_counts",
    """
    SELECT o_custkey AS customer_id, count(DISTINCT l_suppkey) AS n_stores,
           (count(DISTINCT l_suppkey) >= 20)::INT AS many_stores
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1
    """,
)
def feat_distinct_counts(t: Source) -> DataFrame:
    # The inner join can be split when skewed, an outer one only on its preserved side. Customers
    # without lines come with a pair that has no supplier, so one distinct serves both.
    lines = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    pairs = lines.select(F.col("o_custkey").alias("customer_id"), "l_suppkey")
    buyers = t.orders.select(F.col("o_custkey").alias("customer_id"), F.lit(None).alias("l_suppkey"))
    counted = pairs.unionByName(buyers).distinct().groupBy("customer_id")
    n_stores = F.count("l_suppkey")
    return counted.agg(n_stores.alias("n_stores"), as_flag(n_stores >= 20).alias("many_stores"))


@query(
    "feat_distinct_conditional",
    """
    SELECT o_custkey AS customer_id,
           count(DISTINCT CASE WHEN p_type = 'PROMO' AND o_orderdate >=
               (SELECT max(o_orderdate) FROM orders) - INTERVAL 900 DAY THEN o_orderkey END)
               AS promo_purchases
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1
    """,
)
def feat_distinct_conditional(t: Source) -> DataFrame:
    # One row per purchase before the join, whatever its number of lines.
    promo = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .groupBy("l_orderkey")
        .agg(ever(F.col("p_type") == "PROMO").alias("promo"))
    )
    recent = F.col("o_orderdate") >= days_before(matrix.as_of(t), 900)
    joined = t.orders.join(promo, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        n_distinct_where(F.col("promo") & recent, F.col("o_orderkey")).alias("promo_purchases")
    )


@query(
    "conditional_aggregates",
    """
    SELECT l_suppkey AS store_id,
           max(l_returnflag = 'R')::INT AS ever_returned,
           (NOT max(CASE WHEN l_discount > 0.02 THEN l_linestatus = 'F' END))::INT AS never_f,
           count(CASE WHEN l_tax > 0.04 THEN 1 END) AS n_taxed,
           sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END)::DOUBLE AS returned,
           avg(l_quantity) > 25.5 AS large_lines,
           count(CASE WHEN l_linestatus = 'O' THEN 1 END) / nullif(count(*), 0) >= 0.5 AS half_open,
           (count(DISTINCT l_returnflag) = 1) AS one_flag, count(DISTINCT l_linenumber) > 1 AS lines
    FROM lineitem GROUP BY 1
    """,
)
def conditional_aggregates(t: Source) -> DataFrame:
    discounted = F.when(F.col("l_discount") > 0.02, F.col("l_linestatus") == "F")
    returned = F.col("l_returnflag") == "R"
    return t.lineitem.groupBy(F.col("l_suppkey").alias("store_id")).agg(
        as_flag(ever(returned)).alias("ever_returned"),
        as_flag(never(discounted)).alias("never_f"),
        count_where(F.col("l_tax") > 0.04).alias("n_taxed"),
        sum_where(returned, F.col("l_quantity")).alias("returned"),
        (mean(F.col("l_quantity")) > 25.5).alias("large_lines"),
        (share(F.col("l_linestatus") == "O") >= 0.5).alias("half_open"),
        one_only(F.col("l_returnflag")).alias("one_flag"),
        several(F.col("l_linenumber")).alias("lines"),
    )
