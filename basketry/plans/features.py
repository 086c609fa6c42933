"""Thirty 0/1 flags per customer from one pass over items and one over purchases.

Items are rolled up to their purchase first; an item's time is its purchase's time, so every
item condition can be decided there and amounts are not counted once per item. Purchases are
then rolled up to the customer. Both steps are plain aggregates with fixed-width or min/max
states: a hot purchase or customer leaves each map task as a single partial row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.aggregates import (
    as_flag,
    count_where,
    ever,
    mean,
    never,
    one_only,
    several,
    share,
    sum_where,
)
from basketry.functions.dates import (
    Moment,
    days_before,
    in_window,
    is_weekday,
    is_weekend,
    moment,
    sunday_to_thursday,
)
from basketry.operators.dedup import latest_by_key
from basketry.schemas import VERSION

IDENTITY = ("customer_id", "first_name", "last_name", "loyalty_card_number")

# A category set fits one 64-bit mask per this many categories; beyond the word limit the
# distinct categories are counted from (customer, category) pairs instead.
MASK_BITS = 63
MASK_WORDS = 4


@dataclass(frozen=True)
class Terms:
    """Category names and limits the flags are defined by.

    Fixed values: the category names as they are spelt in the data.
    """

    categories: Mapping[str, str] = field(
        default_factory=lambda: {
            "milk": "молочные продукты",
            "fruit": "фрукты и ягоды",
            "veggies": "овощи и зелень",
            "bakery": "зерновые и хлебобулочные изделия",
            "meat": "мясо, рыба, яйца и бобовые",
        }
    )
    bulk_over: float = 1000
    low_cost_under: float = 200
    week_spend_over: float = 2000


@dataclass(frozen=True)
class Scope:
    """What a flag's expression may refer to."""

    as_of: Column
    terms: Terms
    compat: bool = False

    @property
    def time(self) -> Column:
        return F.col("purchase_datetime")

    def since(self, days: int) -> Column:
        return in_window(self.time, self.as_of, days, closed=False)

    def within(self, days: int) -> Column:
        return in_window(self.time, self.as_of, days)

    def bought(self, category: str, when: Column) -> Column:
        """Some item of the category, at a time; unknown for a purchase without items."""
        known = F.when(F.col("n_items").isNotNull(), when)
        return F.col(f"has_{category}") & known


Aggregate = Callable[[Scope], Column]


@dataclass(frozen=True)
class Flag:
    """One flag: a boolean aggregate over a customer's purchases.

    ``without`` is its value for customers with no purchase; ``member`` also asks for loyalty
    membership. Flags without a rule come from elsewhere: the customer's own row, or the number
    of distinct categories.
    """

    name: str
    rule: Aggregate | None = None
    without: int = 0
    member: bool = False


def _payment(method: str) -> Aggregate:
    def rule(s: Scope) -> Column:
        # The golden run counts every known payment method here, whichever it is.
        used = F.col("payment_method")
        return share(used.isNotNull() if s.compat else used == method) >= 0.7

    return rule


def _weekday(s: Scope) -> Column:
    return share(sunday_to_thursday(s.time) if s.compat else is_weekday(s.time)) >= 0.6


def _without_meat(s: Scope) -> Column:
    return ~ever(F.col("has_meat") & s.since(90), null_as=False)


NEW_CUSTOMER = "new_customer"
LOYAL, FRUIT = "loyal_customer", "fruit_lover"
FIRST_OF = "_first_of_purchase"
VARIED = "varied_shopper"
VARIED_FROM = 4
NEW_DAYS = 30

# The flags in output order; the names and limits are fixed values.
FLAGS: tuple[Flag, ...] = (
    Flag("bought_milk_last_30d", lambda s: ever(s.bought("milk", s.within(30)))),
    Flag("bought_fruits_last_14d", lambda s: ever(s.bought("fruit", s.within(14)))),
    Flag(
        "not_bought_veggies_14d",
        lambda s: never(s.bought("veggies", s.since(30 if s.compat else 14))),
    ),
    Flag("recurrent_buyer", lambda s: count_where(s.within(30)) > 2),
    Flag(
        "inactive_14_30",
        lambda s: count_where(s.time.between(days_before(s.as_of, 30), days_before(s.as_of, 14)))
        == 0,
        without=1,
    ),
    Flag(NEW_CUSTOMER),
    Flag("delivery_user", lambda s: ever(F.col("is_delivery"))),
    Flag("organic_preference", lambda s: ever(F.col("has_organic"))),
    Flag("bulk_buyer", lambda s: mean(F.col("total_amount")) > s.terms.bulk_over),
    Flag("low_cost_buyer", lambda s: mean(F.col("total_amount")) < s.terms.low_cost_under),
    Flag("buys_bakery", lambda s: ever(F.col("has_bakery"))),
    Flag(LOYAL, lambda s: count_where(F.col(FIRST_OF)) >= 3, member=True),
    Flag("multicity_buyer", lambda s: several(F.col("city_no"))),
    Flag("bought_meat_last_week", lambda s: ever(F.col("has_meat") & s.since(7))),
    Flag("night_shopper", lambda s: ever(F.hour(s.time) > 20)),
    Flag("morning_shopper", lambda s: ever(F.hour(s.time) < 10)),
    Flag("prefers_cash", _payment("cash")),
    Flag("prefers_card", _payment("card")),
    Flag("weekend_shopper", lambda s: share(is_weekend(s.time)) >= 0.6),
    Flag("weekday_shopper", _weekday),
    Flag("single_item_buyer", lambda s: share(F.col("n_items") == 1) >= 0.5),
    Flag(VARIED),
    Flag("store_loyal", lambda s: one_only(F.col("store_id"))),
    Flag("switching_store", lambda s: several(F.col("store_id"))),
    Flag("family_shopper", lambda s: mean(F.col("n_items")) >= 4),
    Flag("early_bird", lambda s: ever(F.hour(s.time).between(12, 14))),
    Flag("no_purchases", lambda s: F.count("purchase_id") == 0, without=1),
    Flag(
        "recent_high_spender",
        lambda s: sum_where(s.since(7), F.col("total_amount")) > s.terms.week_spend_over,
    ),
    Flag(FRUIT, lambda s: count_where(F.col(FIRST_OF) & F.col("has_fruit") & s.since(30)) >= 3),
    Flag("vegetarian_profile", _without_meat, without=1),
)
FLAG_NAMES = tuple(f.name for f in FLAGS)


def category_bits(products: DataFrame) -> list | None:
    """The distinct category ids, or None where there are too many for the masks."""
    limit = MASK_BITS * MASK_WORDS
    ids = products.select("category_id").dropna().distinct().limit(limit + 1).collect()
    return sorted(row[0] for row in ids) if len(ids) <= limit else None


def _masks(ids: Sequence | None) -> dict[str, Column]:
    """Per word of up to 63 categories, the bit of a product's category in it."""
    words = {}
    for start in range(0, len(ids or ()), MASK_BITS):
        chunk = F.array(*(F.lit(i) for i in ids[start : start + MASK_BITS]))
        place = F.array_position(chunk, F.col("category_id")).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place - 1)
        words[f"mask_{start // MASK_BITS}"] = F.when(place > 0, bit)
    return words


def roll_up_items(
    items: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    terms: Terms,
    ids: Sequence | None = None,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per purchase: number of items, categories of interest, organic, category mask.

    ``extra`` adds aggregates over item columns. The product side is a projection of two stored
    tables, so Catalyst knows its size and broadcasts it only while small.
    """
    extra = dict(extra or {})
    names = {c: F.col("category_name") == name for c, name in terms.categories.items()}
    goods = (
        products.select("product_id", "category_id", "is_organic")
        .join(categories.select("category_id", "category_name"), "category_id", "left")
        .select(
            "product_id",
            F.col("is_organic").alias("has_organic"),
            *(cond.alias(f"has_{c}") for c, cond in names.items()),
            *(mask.alias(word) for word, mask in _masks(ids).items()),
        )
    )
    words = [c for c in goods.columns if c.startswith("mask_")]
    return (
        items.join(goods, "product_id", "left")
        .groupBy("purchase_id")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            *(ever(F.col(c)).alias(c) for c in ("has_organic", *(f"has_{c}" for c in names))),
            *(F.bit_or(w).alias(w) for w in words),
            *(expr.alias(name) for name, expr in extra.items()),
        )
    )


def item_facts(
    purchases: DataFrame,
    items: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    empty: bool = True,
) -> DataFrame:
    """Purchases with their items, each with its product and category; item grain.

    ``empty`` keeps purchases without items. They are added to an inner join, not kept by an
    outer one: AQE can split a purchase with very many items only in the former.
    """
    goods = products.join(
        categories.select("category_id", "category_name"), "category_id", "left"
    )
    facts = purchases.join(items, "purchase_id")
    if empty:
        filled = items.select("purchase_id").distinct()
        bare = purchases.join(filled, "purchase_id", "left_anti")
        facts = facts.unionByName(bare, allowMissingColumns=True)
    return facts.join(goods, "product_id", "left")


def with_basket(purchases: DataFrame, baskets: DataFrame) -> DataFrame:
    """Purchases with the roll-up of their items, NULL where they have none."""
    return purchases.join(baskets, "purchase_id", "left")


def store_city(purchases: DataFrame, stores: DataFrame, addresses: DataFrame) -> DataFrame:
    """Purchases with the city of their store.

    ``city_no`` stands for the city by the smallest address id in it: comparing numbers instead
    of names keeps the customer roll-up a hash aggregate.
    """
    places = stores.select("store_id", "address_id")
    # Most addresses are customers': those of stores are picked out before anything is shuffled.
    known = addresses.select("address_id", "city").join(places, "address_id", "left_semi")
    places = places.join(known, "address_id", "left")
    cities = places.groupBy("city").agg(F.min("address_id").alias("city_no"))
    numbered = places.join(cities, "city", "left").select("store_id", "city", "city_no")
    return purchases.join(numbered, "store_id", "left")


def purchase_rows(
    purchases: DataFrame, baskets: DataFrame, stores: DataFrame, addresses: DataFrame
) -> DataFrame:
    """Purchases with their basket and the city of the store."""
    return store_city(with_basket(purchases, baskets), stores, addresses)


def customer_flags(rows: DataFrame, scope: Scope, names: Sequence[str] = FLAG_NAMES) -> DataFrame:
    """The roll-up to the customer: one boolean per flag, NULL where nothing is known."""
    wanted = [f for f in FLAGS if f.name in names]
    if LOYAL in names or FRUIT in names:
        # These two count purchases, and a purchase has a row for each time it was stated with.
        # Its row with recent fruit comes first, if any. Rows lie by purchase already.
        fruit = [(F.col("has_fruit") & scope.since(30)).desc_nulls_last()] if FRUIT in names else []
        once = Window.partitionBy("customer_id", "purchase_id").orderBy(*fruit, "purchase_id")
        known = F.col("purchase_id").isNotNull()
        rows = rows.withColumn(FIRST_OF, (F.row_number().over(once) == 1) & known)
    aggregates = [f.rule(scope).alias(f.name) for f in wanted if f.rule]
    words = [c for c in rows.columns if c.startswith("mask_")]
    if VARIED in names and words:
        # A word none of the customer's categories falls into has no value.
        found = [F.coalesce(F.bit_count(F.bit_or(w)), F.lit(0)) for w in words]
        aggregates.append((reduce(Column.__add__, found) >= VARIED_FROM).alias(VARIED))
    return rows.groupBy("customer_id").agg(*aggregates)


def with_variety(
    flags: DataFrame,
    purchases: DataFrame,
    items: DataFrame,
    products: DataFrame,
    categories: DataFrame,
) -> DataFrame:
    """The roll-up with ``varied_shopper``, from distinct (customer, category) pairs.

    Any number of categories will do. The flag is NULL for customers without a known category.
    """
    facts = item_facts(
        purchases.select("purchase_id", "customer_id"),
        items.select("purchase_id", "product_id"),
        products.select("product_id", "category_id"),
        categories,
        empty=False,
    )
    pairs = facts.select("customer_id", "category_id").dropna(subset=["category_id"]).distinct()
    varied = pairs.groupBy(F.col("customer_id").alias("_of")).agg(
        (F.count(F.lit(1)) >= VARIED_FROM).alias(VARIED)
    )
    return flags.join(varied, F.col("customer_id").eqNullSafe(F.col("_of")), "left").drop("_of")


def assemble(customers: DataFrame, flags: DataFrame, as_of: Column) -> DataFrame:
    """Identity columns and all flags as 0/1 for every customer, also those without purchases."""
    known = [F.col(c) for c in IDENTITY]
    joined = customers.join(flags, "customer_id", "left")
    columns = []
    for flag in FLAGS:
        if flag.name == NEW_CUSTOMER:
            value = in_window(F.col("registration_date"), as_of, NEW_DAYS)
        else:
            value = F.col(flag.name)
        if flag.member:
            value = value & F.col("is_loyalty_member")
        # Flags with ``without=1`` have a value in every roll-up row: only a missing row is NULL.
        columns.append(F.coalesce(as_flag(value), F.lit(flag.without)).alias(flag.name))
    return joined.select(*known, *columns)


def feature_matrix(
    marts: Mapping[str, DataFrame],
    as_of: Moment,
    terms: Terms | None = None,
    compat: bool = False,
) -> DataFrame:
    """Four identity columns and thirty flags per customer, as of a given moment.

    ``compat`` follows the rules of the golden run where those differ (30 days of vegetables,
    payment shares over any known method, Sunday to Thursday as weekdays).
    """
    terms = terms or Terms()
    scope = Scope(moment(as_of), terms, compat)
    ids = category_bits(marts["dim_products"])
    baskets = roll_up_items(
        marts["fact_purchase_items"].select("purchase_id", "product_id"),
        marts["dim_products"],
        marts["categories"],
        terms,
        ids,
    )
    rows = purchase_rows(
        marts["fact_purchases"].select(
            "purchase_id", "customer_id", "store_id", "total_amount", "payment_method",
            "is_delivery", "purchase_datetime",
        ),
        baskets,
        marts["dim_stores"],
        marts["addresses"],
    )
    flags = customer_flags(rows, scope)
    if VARIED not in flags.columns:
        flags = with_variety(
            flags,
            marts["fact_purchases"],
            marts["fact_purchase_items"],
            marts["dim_products"],
            marts["categories"],
        )
    customers = latest_by_key(
        marts["dim_customers"].select(
            *IDENTITY, "registration_date", "is_loyalty_member", VERSION
        ),
        ["customer_id"],
    )
    return assemble(customers, flags, scope.as_of)
