"""Document shapes, RAW columns derived from them, and mart keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# Document fields as the sources deliver them.
_PLACE = "country string, city string, street string, house string"
_POINT = "coordinates struct<latitude: double, longitude: double>"
_KBJU = "struct<calories: double, protein: double, fat: double, carbohydrates: double>"
_MAKER = "struct<name: string, country: string, website: string, inn: string>"
_LOCATION = f"struct<{_PLACE}, postal_code string, {_POINT}>"
_DELIVERY = f"struct<{_PLACE}, apartment string, postal_code string>"

_DOCUMENTS = {
    "products": f"""
        id string, name string, `group` string, description string, kbju {_KBJU}, price double,
        unit string, origin_country string, expiry_days int, is_organic boolean, barcode string,
        manufacturer {_MAKER}""",
    "stores": f"""
        store_id string, store_name string, store_network string, store_type_description string,
        type string, categories array<string>,
        manager struct<name: string, phone: string, email: string>,
        location {_LOCATION},
        opening_hours struct<mon_fri: string, sat: string, sun: string>,
        accepts_online_orders boolean, delivery_available boolean, warehouse_connected boolean,
        last_inventory_date string""",
    "customers": f"""
        customer_id string, first_name string, last_name string, email string, phone string,
        birth_date string, gender string, registration_date string, is_loyalty_member boolean,
        loyalty_card_number string, purchase_location {_LOCATION}, delivery_address {_DELIVERY},
        preferences struct<preferred_language: string, preferred_payment_method: string,
                           receive_promotions: boolean>""",
    "purchases": f"""
        purchase_id string,
        customer struct<customer_id: string, first_name: string, last_name: string, email: string,
                        phone: string, is_loyalty_member: boolean, loyalty_card_number: string>,
        store struct<store_id: string, store_name: string, store_network: string,
                     location: {_LOCATION}>,
        items array<struct<product_id: string, name: string, category: string, quantity: int,
                           unit: string, price_per_unit: double, total_price: double,
                           kbju: {_KBJU}, manufacturer: {_MAKER}>>,
        total_amount double, payment_method string, is_delivery boolean,
        delivery_address {_DELIVERY}, purchase_datetime string""",
}

ENTITIES = tuple(_DOCUMENTS)
SENSITIVE = frozenset({"stores", "customers", "purchases"})
ENTITY_ID = {
    "products": "id",
    "stores": "store_id",
    "customers": "customer_id",
    "purchases": "purchase_id",
}
CORRUPT = "_corrupt"

# Mart tables and the key each one keeps a single, newest row for.
MART_KEYS = {
    "addresses": (
        "country", "city", "street", "house", "apartment", "postal_code", "latitude", "longitude",
    ),
    "categories": ("category_name",),
    "manufacturers": ("inn",),
    "store_networks": ("store_network_name",),
    "store_managers": ("manager_name", "manager_phone"),
    "dim_customers": ("customer_id", "loyalty_card_number"),
    "dim_products": ("product_id",),
    "dim_stores": ("store_id",),
    "store_categories": ("store_id", "category_id"),
    "fact_purchases": ("purchase_id", "purchase_datetime"),
    "fact_purchase_items": ("purchase_id", "product_id"),
}
# The columns of a key by which rows are dealt to buckets, where that is not the whole key: what
# lookups know of an address.
BUCKET_KEYS = {"addresses": ("country", "city", "street", "house")}
VERSION = "event_time"

# Retention in days.
RAW_DAYS = 180
FACT_DAYS = 360


def document_schema(entity: str) -> T.StructType:
    """Typed shape of one document."""
    return T.StructType.fromDDL(_DOCUMENTS[entity])


def text_schema(entity: str) -> T.StructType:
    """Same shape with every leaf as text, so RAW keeps values exactly as they were written."""
    return _as_text(document_schema(entity))


def only(schema: T.StructType, paths: Iterable[str]) -> T.StructType:
    """The schema with the named fields alone, each with all that is below it.

    A parser given it still reads every text to its end, but builds no values that are not used.
    """
    wanted: dict[str, list[str]] = {}
    for path in paths:
        name, _, rest = path.partition(".")
        wanted.setdefault(name, []).append(rest)
    if unknown := wanted.keys() - set(schema.names):
        raise ValueError(f"no such fields: {sorted(unknown)}")
    kept = []
    for field in schema:
        if field.name in wanted:
            below, kind = wanted[field.name], field.dataType
            if "" not in below:
                many = isinstance(kind, T.ArrayType)
                kind = only(kind.elementType if many else kind, below)
                kind = T.ArrayType(kind) if many else kind
            kept.append(T.StructField(field.name, kind))
    return T.StructType(kept)


def _as_text(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    return T.StringType()
