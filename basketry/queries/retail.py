"""Retail documents made out of the given tables, and the RAW tables they flatten to.

part -> products, supplier -> stores, customer -> customers. Every order line is one purchase
document (a purchase thus arrives several times, in differing states), so that no order's lines
have to be gathered in one place. ``event_time`` of a line is its ship date; other entities
arrive in one run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.flatten import flatten
from basketry.operators.masking import mask_topic
from basketry.queries.registry import Slice, Source
from basketry.schemas import only, text_schema
from basketry.sources.envelopes import split_valid, to_envelope

RUN = "2024-02-01 07:00:00"
# The tables that are dealt to slices of an entity's documents, and by which keys. The first one has
# a row for each document.
_DEALT = {
    "products": {"part": "p_partkey"},
    "stores": {"supplier": "s_suppkey"},
    "customers": {"customer": "c_custkey"},
    "purchases": {"lineitem": "l_orderkey", "orders": "o_orderkey"},
}


def _text(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _place(country: Column, city: Column, street: Column, house: Column) -> list[Column]:
    named = {"country": country, "city": city, "street": street, "house": house}
    return [col.cast("string").alias(name) for name, col in named.items()]


def _point(key: Column) -> Column:
    return F.struct(
        key.cast("double").alias("latitude"), (-key).cast("double").alias("longitude")
    ).alias("coordinates")


def _store_location(key: Column) -> Column:
    """The place a nation's shops are at."""
    return F.struct(
        *_place(F.col("r_name"), F.col("n_name"), _text("Main street ", key), key),
        F.lpad(key.cast("string"), 6, "0").alias("postal_code"),
        _point(key),
    )


def _delivery(key: Column, segment: Column) -> Column:
    return F.struct(
        *_place(F.col("r_name"), F.col("n_name"), _text(" ", segment, " Lane"), key % 50),
        key.cast("string").alias("apartment"),
        F.lpad(key.cast("string"), 6, "0").alias("postal_code"),
    )


def _with_nation(t: Source, df: DataFrame, key: str) -> DataFrame:
    """Left joins, here and below: every key resolves, and the equalities an inner join lets
    Catalyst infer multiply over the many derived columns and take seconds to plan."""
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return df.join(
        nations.select("n_nationkey", "n_name", "r_name"),
        F.col(key) == F.col("n_nationkey"),
        "left",
    )


def products(t: Source) -> DataFrame:
    size = F.col("p_size")
    maker = F.struct(
        F.col("p_brand").alias("name"),
        F.lit("Country").alias("country"),
        _text("https://", F.lower(F.col("p_brand"))).alias("website"),
        F.regexp_replace("p_brand", "[^0-9]", "").alias("inn"),
    )
    return t.part.select(
        _text("PRD-", F.col("p_partkey")).alias("id"),
        F.col("p_name").alias("name"),
        _text("🍏 Группа ", size % 6).alias("group"),
        _text(F.col("p_name"), " 🥖 ", F.col("p_brand")).alias("description"),
        F.struct(
            (size / 2).alias("calories"),
            (size / 4).alias("protein"),
            (size / 8).alias("fat"),
            size.cast("double").alias("carbohydrates"),
        ).alias("kbju"),
        F.col("p_retailprice").alias("price"),
        F.lit("pcs").alias("unit"),
        F.lit("Country").alias("origin_country"),
        size.alias("expiry_days"),
        (size <= 10).alias("is_organic"),
        F.col("p_partkey").cast("string").alias("barcode"),
        F.when(size % 7 != 0, maker).alias("manufacturer"),
    )


def stores(t: Source) -> DataFrame:
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    many = F.array(F.lit("🥖 Группа 1"), F.lit("🥛 Группа 3"), F.lit("🍏 Группа 5"))
    few = F.array(F.lit("🥖 Группа 1"), F.lit("🥦 Прочее, без группы"))
    return _with_nation(t, t.supplier, "s_nationkey").select(
        _text("Store-", key).alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("r_name").alias("store_network"),
        F.lit("shop").alias("store_type_description"),
        F.lit("offline").alias("type"),
        F.when(nation % 2 == 0, many).otherwise(few).alias("categories"),
        F.struct(
            F.col("s_name").alias("name"),
            _text("8 (900) ", F.lpad(key.cast("string"), 7, "0")).alias("phone"),
            _text(F.col("s_name"), "@Example.org").alias("email"),
        ).alias("manager"),
        _store_location(nation).alias("location"),
        F.struct(
            F.lit("09:00-21:00").alias("mon_fri"),
            F.lit("10:00-20:00").alias("sat"),
            F.lit("10:00-18:00").alias("sun"),
        ).alias("opening_hours"),
        (key % 2 == 0).alias("accepts_online_orders"),
        (key % 3 == 0).alias("delivery_available"),
        F.lit(True).alias("warehouse_connected"),
        F.lit("2024-01-31").alias("last_inventory_date"),
    )


def customers(t: Source) -> DataFrame:
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    day = F.date_add(F.lit("1990-01-01").cast("date"), (key * 7 % 8000).cast("int"))
    return _with_nation(t, t.customer, "c_nationkey").select(
        _text(" CUS-", key).alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.nullif(segment, F.lit("BUILDING")).alias("last_name"),
        _text(F.col("c_name"), "@Example.com ").alias("email"),
        _text("+7", F.lpad(key.cast("string"), 10, "9")).alias("phone"),
        day.cast("string").alias("birth_date"),
        F.when(key % 3 == 0, "male").when(key % 3 == 1, "Female").otherwise("-").alias("gender"),
        F.lit("2001-01-01T10:00:00.000123").alias("registration_date"),
        (segment == "BUILDING").alias("is_loyalty_member"),
        _text("LOYAL-", key).alias("loyalty_card_number"),
        _store_location(F.col("c_nationkey")).alias("purchase_location"),
        _delivery(key, segment).alias("delivery_address"),
        F.struct(
            F.lit("en").alias("preferred_language"),
            F.lit("Cash").alias("preferred_payment_method"),
            F.lit(False).alias("receive_promotions"),
        ).alias("preferences"),
    )


def purchases(t: Source) -> DataFrame:
    """One document per order line: the line's product and a gift from its supplier.

    Orders meet their customers first, so that the lines, which are more, are shuffled once.
    """
    people = _with_nation(t, t.customer, "c_nationkey")
    ordered = t.orders.join(people, F.col("o_custkey") == F.col("c_custkey"), "left")
    joined = t.lineitem.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    price = F.col("l_extendedprice")

    def item(product: Column, quantity: Column, total: Column) -> Column:
        return F.struct(
            product.alias("product_id"),
            quantity.cast("int").alias("quantity"),
            F.lit(" PCS").alias("unit"),
            total.alias("total_price"),
        )

    line = item(_text("PRD-", F.col("l_partkey")), F.col("l_quantity"), price)
    gift = item(_text("GIFT-", F.col("l_suppkey")), F.lit(1), F.lit(0.0))
    status = F.col("o_orderstatus")
    return joined.select(
        _text("ORD-", F.col("o_orderkey")).alias("purchase_id"),
        F.struct(
            _text("CUS-", F.col("o_custkey")).alias("customer_id"),
            _text(F.col("c_name"), "@Example.com").alias("email"),
        ).alias("customer"),
        F.struct(_text("Store-", F.col("l_suppkey")).alias("store_id")).alias("store"),
        F.array(line, gift).alias("items"),
        F.col("o_totalprice").alias("total_amount"),
        F.when(status == "F", "Cash").when(status == "O", "card").alias("payment_method"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("is_delivery"),
        F.when(status != "P", _delivery(F.col("c_custkey"), F.col("c_mktsegment"))).alias(
            "delivery_address"
        ),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("purchase_datetime"),
        F.col("l_shipdate").cast("timestamp").alias("_seen"),
    )


def slices(t: Source, entity: str, rows: int, most: int) -> list[Source]:
    """The tables in slices that each give about ``rows`` of the entity's documents; as every slice
    reads the tables again, ``most`` slices of more where there are too many."""
    dealt = _DEALT[entity]
    n = min(most, -(-getattr(t, next(iter(dealt))).count() // rows))
    return [Slice(t, dealt, k, n) for k in range(n)] if n > 1 else [t]


def envelopes(t: Source, entity: str) -> DataFrame:
    docs = {
        "products": products,
        "stores": stores,
        "customers": customers,
        "purchases": purchases,
    }[entity](t)
    if entity != "purchases":
        return to_envelope(mask_topic(docs, entity), entity, RUN)
    masked = mask_topic(docs, entity)
    body = F.struct(*(c for c in masked.columns if c != "_seen"))
    return masked.select(
        F.lit(entity).alias("topic"),
        F.to_json(body).alias("json_data"),
        F.col("_seen").alias("event_time"),
    )


def raw(t: Source, entity: str, fields: Sequence[str] = ()) -> DataFrame:
    """RAW rows: the documents masked, put into envelopes, parsed and flattened.

    With ``fields`` the columns of these parts of the documents only. A scan of stored RAW leaves
    unread columns out by itself; a parser has to be told.
    """
    shape = only(text_schema(entity), fields) if fields else entity
    good, _ = split_valid(envelopes(t, entity), shape)
    return flatten(good, shape, keep_json=False)
