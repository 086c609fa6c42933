"""RAW rows to the deduplicated, typed mart tables.

Every function takes RAW DataFrames (text columns plus ``event_time``) and the stored tables it
looks up, and gives the newest row per key of its table. Rows are typed, filtered and
deduplicated before a lookup, so joins see each row once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.clean import (
    clean_label,
    clean_text,
    clean_trim,
    coalesce_key,
    fixed_len,
    null_of,
    strip_emoji,
    surrogate_key,
    to_bool,
    to_bool3,
    to_date_or_null,
    to_double,
    to_enum,
    to_float,
    to_int,
    to_money,
    to_short,
    to_ts,
)
from basketry.operators.dedup import latest_by_key, union_sources
from basketry.operators.labels import drop_blank, extract_labels, tidy_labels, unnest
from basketry.operators.lookup import (
    lookup,
    plausible_dates,
    require,
    require_any,
    split_valid_rows,
)
from basketry.schemas import MART_KEYS, VERSION

# Gender words, postal code length.
GENDERS = ("male", "female")
POSTAL_LENGTH = 6

PLACE = ("country", "city", "street", "house")
MAKER = ("manufacturer_name", "manufacturer_country", "manufacturer_website")

# Columns a typed row must have; rows lacking one go to the rejects with the reason.
REQUIRED_CUSTOMER = ("customer_id", "loyalty_card_number", "registration_date")
REQUIRED_PRODUCT = ("product_id", "price")
REQUIRED_STORE = ("store_id",)
REQUIRED_PURCHASE = ("purchase_id", "customer_id", "store_id", "total_amount", "purchase_datetime")
REQUIRED_ITEM = ("purchase_id", "product_id", "purchase_datetime")


def _place(prefix: str) -> dict[str, Column]:
    return {p: clean_text(F.col(f"{prefix}_{p}")) for p in PLACE}


def _newest(df: DataFrame, table: str) -> DataFrame:
    return latest_by_key(df, MART_KEYS[table])


def places(customers: DataFrame, stores: DataFrame, purchases: DataFrame) -> DataFrame:
    """The distinct places these rows are going to look up among the addresses."""
    named = (
        (customers, "purchase_location"),
        (customers, "delivery_address"),
        (stores, "location"),
        (purchases, "delivery_address"),
    )
    return union_sources(
        *(df.select(*(c.alias(n) for n, c in _place(prefix).items())) for df, prefix in named)
    ).distinct()


def addresses(customers: DataFrame, stores: DataFrame) -> DataFrame:
    """Customers' delivery places (at the point they shop) and stores' places."""

    def columns(prefix: str, point: str, apartment: Column) -> list[Column]:
        named = {
            **_place(prefix),
            "apartment": apartment,
            "postal_code": clean_trim(F.col(f"{prefix}_postal_code")),
            "latitude": to_double(F.col(f"{point}_coordinates_latitude")),
            "longitude": to_double(F.col(f"{point}_coordinates_longitude")),
        }
        return [*(c.alias(n) for n, c in named.items()), F.col(VERSION)]

    apartment = clean_text(F.col("delivery_address_apartment"))
    both = union_sources(
        customers.select(*columns("delivery_address", "purchase_location", apartment)),
        stores.select(*columns("location", "location", null_of("string"))),
    )
    newest = _newest(both.filter(F.col("country").isNotNull()), "addresses")
    key = surrogate_key(*(F.col(k) for k in MART_KEYS["addresses"]))
    return newest.select(key.alias("address_id"), "*")


def categories(products: DataFrame) -> DataFrame:
    names = products.select(clean_label(F.col("group")).alias("category_name"), VERSION)
    newest = _newest(names.filter(F.col("category_name").isNotNull()), "categories")
    return newest.select(surrogate_key(F.col("category_name")).alias("category_id"), "*")


def manufacturers(products: DataFrame) -> DataFrame:
    rows = products.select(
        clean_trim(F.col("manufacturer_inn")).alias("inn"),
        *(
            clean_text(F.col(c)).alias(c)
            for c in ("manufacturer_name", "manufacturer_country", "manufacturer_website")
        ),
        VERSION,
    )
    return _newest(rows.dropna(subset=["inn", "manufacturer_name"]), "manufacturers")


def store_networks(stores: DataFrame) -> DataFrame:
    """Network names, each store counting with its latest one only."""
    named = stores.select(
        clean_text(F.col("store_id")).alias("store_id"),
        clean_text(F.col("store_network")).alias("store_network_name"),
        VERSION,
    ).filter(F.col("store_network_name").isNotNull())
    current = latest_by_key(named, ["store_id"]).drop("store_id")
    newest = _newest(current, "store_networks")
    key = surrogate_key(F.col("store_network_name"))
    return newest.select(key.alias("store_network_id"), "*")


def store_managers(stores: DataFrame) -> DataFrame:
    rows = stores.select(
        clean_text(F.col("manager_name")).alias("manager_name"),
        clean_trim(F.col("manager_phone")).alias("manager_phone"),
        clean_text(F.col("manager_email")).alias("manager_email"),
        VERSION,
    )
    newest = _newest(require_any(rows, "manager_name", "manager_phone"), "store_managers")
    key = surrogate_key(F.col("manager_name"), F.col("manager_phone"))
    return newest.select(key.alias("manager_id"), "*")


def typed_customers(customers: DataFrame) -> DataFrame:
    """Customers typed, with the address parts still attached."""
    shop, home = "purchase_location", "delivery_address"
    typed = customers.select(
        clean_text(F.col("customer_id")).alias("customer_id"),
        *(clean_text(F.col(c)).alias(c) for c in ("first_name", "last_name", "email")),
        clean_trim(F.col("phone")).alias("phone"),
        to_date_or_null(F.col("birth_date")).alias("birth_date"),
        to_enum(F.col("gender"), GENDERS).alias("gender"),
        to_ts(F.col("registration_date")).alias("registration_date"),
        to_bool(F.col("is_loyalty_member")).alias("is_loyalty_member"),
        clean_text(F.col("loyalty_card_number")).alias("loyalty_card_number"),
        clean_text(F.col("preferences_preferred_language")).alias("preferred_language"),
        clean_text(F.col("preferences_preferred_payment_method")).alias(
            "preferred_payment_method"
        ),
        to_bool(F.col("preferences_receive_promotions")).alias("receive_promotions"),
        *(c.alias(f"shop_{p}") for p, c in _place(shop).items()),
        clean_text(F.col(f"{shop}_postal_code")).alias("shop_postal_code"),
        *(c.alias(f"home_{p}") for p, c in _place(home).items()),
        clean_text(F.col(f"{home}_apartment")).alias("home_apartment"),
        clean_text(F.col(f"{home}_postal_code")).alias("home_postal_code"),
        VERSION,
    )
    return typed


def dim_customers(customers: DataFrame, addresses: DataFrame) -> DataFrame:
    valid, _ = split_valid_rows(typed_customers(customers), REQUIRED_CUSTOMER)
    plausible = plausible_dates(valid, "birth_date", "registration_date")
    rows = _newest(plausible, "dim_customers")
    places = addresses.withColumn("postal_code", F.lower("postal_code"))
    newest = [F.col(VERSION), F.col("address_id")]
    with_shop = lookup(
        rows,
        places,
        [(F.col(f"shop_{p}"), p) for p in (*PLACE, "postal_code")],
        {"address_id": "address_id"},
        null_safe=True,
        unique=False,
        prefer=[F.col("apartment").isNull(), *newest],
    )
    with_both = lookup(
        with_shop,
        places,
        [(F.col(f"home_{p}"), p) for p in (*PLACE, "apartment", "postal_code")],
        {"address_id": "delivery_address_id"},
        null_safe=True,
        unique=False,
        prefer=newest,
    )
    return with_both.select(
        "customer_id", "first_name", "last_name", "email", "phone", "birth_date", "gender",
        "registration_date", "is_loyalty_member", "loyalty_card_number", "address_id",
        "delivery_address_id", "preferred_language", "preferred_payment_method",
        "receive_promotions", VERSION,
    )


def typed_products(products: DataFrame) -> DataFrame:
    return products.select(
        clean_text(F.col("id")).alias("product_id"),
        clean_text(strip_emoji(F.col("name"))).alias("name"),
        clean_label(F.col("group")).alias("label"),
        clean_text(strip_emoji(F.col("description"))).alias("description"),
        *(
            to_float(F.col(f"kbju_{n}")).alias(n)
            for n in ("calories", "protein", "fat", "carbohydrates")
        ),
        to_money(F.col("price")).alias("price"),
        clean_text(strip_emoji(F.col("unit"))).alias("unit"),
        clean_text(strip_emoji(F.col("origin_country"))).alias("origin_country"),
        to_short(F.col("expiry_days")).alias("expiry_days"),
        to_bool(F.col("is_organic")).alias("is_organic"),
        clean_text(F.col("barcode")).alias("barcode"),
        *(clean_text(F.col(c)).alias(c) for c in MAKER),
        clean_trim(F.col("manufacturer_inn")).alias("inn"),
        VERSION,
    )


def dim_products(
    products: DataFrame, manufacturers: DataFrame, categories: DataFrame
) -> DataFrame:
    valid, _ = split_valid_rows(typed_products(products), REQUIRED_PRODUCT)
    rows = _newest(valid, "dim_products")
    made = lookup(
        rows,
        manufacturers,
        [*((F.col(c), c) for c in MAKER), (F.col("inn"), "inn")],
        {"inn": "manufacturer_id"},
        null_safe=True,
    )
    grouped = lookup(
        made, categories, [(F.col("label"), "category_name")], {"category_id": "category_id"}
    )
    return grouped.select(
        "product_id", "name", "category_id", "description", "calories", "protein", "fat",
        "carbohydrates", "price", "unit", "origin_country", "expiry_days", "is_organic",
        "barcode", "manufacturer_id", VERSION,
    )


_STORE_TEXTS = (
    "store_id", "store_name", "store_type_description", "type", "opening_hours_mon_fri",
    "opening_hours_sat", "opening_hours_sun",
)
_STORE_FLAGS = ("accepts_online_orders", "delivery_available", "warehouse_connected")


def typed_stores(stores: DataFrame) -> DataFrame:
    """Stores typed, with manager, network and address parts still attached."""
    return stores.select(
        *(clean_text(F.col(c)).alias(c) for c in _STORE_TEXTS),
        *(to_bool(F.col(c)).alias(c) for c in _STORE_FLAGS),
        to_date_or_null(F.col("last_inventory_date")).alias("last_inventory_date"),
        clean_text(F.col("store_network")).alias("network"),
        clean_text(F.col("manager_name")).alias("manager_name"),
        clean_trim(F.col("manager_phone")).alias("manager_phone"),
        clean_text(F.col("manager_email")).alias("manager_email"),
        *(c.alias(p) for p, c in _place("location").items()),
        fixed_len(F.col("location_postal_code"), POSTAL_LENGTH).alias("postal_code"),
        to_double(F.col("location_coordinates_latitude")).alias("latitude"),
        to_double(F.col("location_coordinates_longitude")).alias("longitude"),
        VERSION,
    )


def dim_stores(
    stores: DataFrame, networks: DataFrame, managers: DataFrame, addresses: DataFrame
) -> DataFrame:
    valid, _ = split_valid_rows(typed_stores(stores), REQUIRED_STORE)
    rows = _newest(valid, "dim_stores")
    networked = lookup(
        rows,
        networks,
        [(F.col("network"), "store_network_name")],
        {"store_network_id": "store_network_id"},
    )
    managed = lookup(
        networked,
        managers,
        [(F.col(c), c) for c in ("manager_name", "manager_phone", "manager_email")],
        {"manager_id": "manager_id"},
        null_safe=True,
    )
    placed = lookup(
        managed,
        addresses.filter(F.col("apartment").isNull()),
        [(F.col(c), c) for c in (*PLACE, "postal_code", "latitude", "longitude")],
        {"address_id": "address_id"},
        null_safe=True,
    )
    return placed.select(
        "store_id", "store_name", "store_network_id", "store_type_description", "type",
        "manager_id", "address_id", *_STORE_TEXTS[4:], *_STORE_FLAGS, "last_inventory_date",
        VERSION,
    )


def store_categories(stores: DataFrame, categories: DataFrame) -> DataFrame:
    """Store-category pairs; unknown labels get key 0.

    Labels come from the list that RAW keeps. Rows of before it did have the joined text only, which
    is parsed; the pattern cannot express every label.
    """
    labels = drop_blank(tidy_labels(extract_labels(strip_emoji(F.col("categories")))))
    if "categories_list" in stores.columns:
        listed = F.transform("categories_list", lambda x: F.trim(strip_emoji(x)))
        labels = F.coalesce(drop_blank(listed), labels)
    pairs = unnest(require(stores, "store_id"), labels, "label").select(
        clean_text(F.col("store_id")).alias("store_id"),
        clean_text(F.col("label")).alias("label"),
        VERSION,
    )
    # Fewer rows first: the label stands for the category until the lookup.
    pairs = latest_by_key(pairs, ["store_id", "label"])
    found = lookup(
        pairs, categories, [(F.col("label"), "category_name")], {"category_id": "category_id"}
    )
    return _newest(
        found.select("store_id", coalesce_key(F.col("category_id")).alias("category_id"), VERSION),
        "store_categories",
    )


# What of a purchase document its row is made of.
PURCHASE_FIELDS = (
    "purchase_id", "customer.customer_id", "store.store_id", "total_amount", "payment_method",
    "is_delivery", "delivery_address", "purchase_datetime",
)

# What of an item is read, and the RAW columns that purchases and their items are made of.
ITEM_PARTS = ("product_id", "quantity", "unit", "price_per_unit", "total_price")


def purchase_columns(items: str = "all") -> list[str]:
    place = (f"delivery_address_{p}" for p in (*PLACE, "apartment", "postal_code"))
    parts = ["items"] if items == "all" else [f"items_{p}" for p in ITEM_PARTS]
    return [
        "purchase_id", "customer_customer_id", "store_store_id", "total_amount", "payment_method",
        "is_delivery", *place, "purchase_datetime", *parts, VERSION,
    ]


def typed_purchases(purchases: DataFrame) -> DataFrame:
    place = "delivery_address"
    return purchases.select(
        clean_text(F.col("purchase_id")).alias("purchase_id"),
        clean_text(F.col("customer_customer_id")).alias("customer_id"),
        clean_text(F.col("store_store_id")).alias("store_id"),
        to_money(F.col("total_amount")).alias("total_amount"),
        clean_text(F.col("payment_method")).alias("payment_method"),
        to_bool3(F.col("is_delivery")).alias("is_delivery"),
        to_ts(F.col("purchase_datetime")).alias("purchase_datetime"),
        *(c.alias(f"to_{p}") for p, c in _place(place).items()),
        clean_text(F.col(f"{place}_apartment")).alias("to_apartment"),
        fixed_len(F.col(f"{place}_postal_code"), POSTAL_LENGTH).alias("to_postal_code"),
        VERSION,
    )


# What a purchase is looked up by among the addresses.
PURCHASE_PLACE = {f"to_{p}": p for p in (*PLACE, "apartment", "postal_code")}


def purchase_rows(purchases: DataFrame) -> DataFrame:
    """Valid purchases, newest row per key, with the parts of their delivery address attached."""
    typed = typed_purchases(purchases)
    return latest_by_key(typed, MART_KEYS["fact_purchases"], required=REQUIRED_PURCHASE)


def place_purchases(rows: DataFrame, addresses: DataFrame) -> DataFrame:
    """The rows with the key of their delivery address, NULL where there is none (yet)."""
    return lookup(
        rows,
        addresses,
        [(F.col(c), p) for c, p in PURCHASE_PLACE.items()],
        {"address_id": "delivery_address_id"},
        unique=False,
        prefer=[F.col(VERSION), F.col("address_id")],
    )


def placed_facts(placed: DataFrame) -> DataFrame:
    return placed.select(
        "purchase_id", "customer_id", "store_id", "total_amount", "payment_method",
        "is_delivery", "delivery_address_id", "purchase_datetime", VERSION,
    )


def fact_purchases(purchases: DataFrame, addresses: DataFrame) -> DataFrame:
    return placed_facts(place_purchases(purchase_rows(purchases), addresses))


def unplaced(placed: DataFrame) -> DataFrame:
    """Purchases that name a whole address no one has sent so far: they wait for it."""
    waiting = placed.filter(F.col("delivery_address_id").isNull())
    return waiting.dropna(subset=list(PURCHASE_PLACE)).drop("delivery_address_id")


def called(waiting: DataFrame, addresses: DataFrame) -> DataFrame:
    """The waiting purchases whose address is among these."""
    known = addresses.select(*(F.col(p).alias(c) for c, p in PURCHASE_PLACE.items())).distinct()
    return waiting.join(known, list(PURCHASE_PLACE), "left_semi").select(waiting.columns)


def typed_items(purchases: DataFrame, items: str = "all") -> DataFrame:
    """Purchase items: every element of the list, or only the first in ``first`` mode.

    What a purchase's items have in common is typed before they are taken apart.
    """
    common = [
        clean_text(F.col("purchase_id")).alias("purchase_id"),
        to_ts(F.col("purchase_datetime")).alias("purchase_datetime"),
        F.col(VERSION),
    ]
    if items == "all":
        rows = purchases.select(*common, F.explode("items").alias("_item"))
    else:
        rows = purchases.select(*common, *(f"items_{p}" for p in ITEM_PARTS))

    def part(name: str) -> Column:
        return F.col(f"_item.{name}" if items == "all" else f"items_{name}")

    return rows.select(
        "purchase_id",
        clean_text(part("product_id")).alias("product_id"),
        to_int(part("quantity")).alias("quantity"),
        clean_text(part("unit")).alias("unit"),
        to_money(part("price_per_unit")).alias("price_per_unit"),
        to_money(part("total_price")).alias("total_price"),
        "purchase_datetime",
        VERSION,
    )


def fact_purchase_items(purchases: DataFrame, items: str = "all") -> DataFrame:
    valid, _ = split_valid_rows(typed_items(purchases, items), REQUIRED_ITEM)
    return _newest(valid, "fact_purchase_items")


def rejects(raw: Mapping[str, DataFrame], items: str = "all") -> DataFrame:
    """Rows no dimension or fact table takes, with the required columns that could not be read."""
    sources = (
        ("customers", "customer_id", typed_customers(raw["customers"]), REQUIRED_CUSTOMER),
        ("stores", "store_id", typed_stores(raw["stores"]), REQUIRED_STORE),
        ("products", "product_id", typed_products(raw["products"]), REQUIRED_PRODUCT),
        ("purchases", "purchase_id", typed_purchases(raw["purchases"]), REQUIRED_PURCHASE),
        ("items", "purchase_id", typed_items(raw["purchases"], items), REQUIRED_ITEM),
    )
    known, _ = split_valid_rows(typed_customers(raw["customers"]), REQUIRED_CUSTOMER)
    plausible = F.to_date("registration_date") > F.col("birth_date")
    odd = known.filter(~F.coalesce(plausible, F.lit(False))).select(
        F.lit("customers").alias("source"), F.col("customer_id").alias("row_id"),
        F.lit("implausible dates").alias("reason"), VERSION,
    )
    return union_sources(
        odd,
        *(
            split_valid_rows(df, required)[1].select(
                F.lit(name).alias("source"), F.col(key).alias("row_id"), "reason", VERSION
            )
            for name, key, df, required in sources
        ),
    )
