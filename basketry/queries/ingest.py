"""Envelopes, masking, flattening and label parsing over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.masking import mask_email as masked_email
from basketry.functions.masking import mask_phone as masked_phone
from basketry.operators.flatten import as_json, explode_items, flatten, join_labels
from basketry.operators.labels import drop_blank, extract_labels, tidy_labels, unnest
from basketry.operators.masking import mask_json
from basketry.operators.masking import mask_nested as mask_fields
from basketry.operators.retention import retain
from basketry.queries import retail
from basketry.queries.registry import Source, query
from basketry.session import scratch_dir
from basketry.sources.documents import read_documents
from basketry.sources.envelopes import (
    read_envelopes,
    split_valid,
    text_envelope,
    to_envelope,
    write_envelopes,
)
from basketry.sources.tables import write_raw

_EVENT = ("event_id", "user_id", "value", "props")
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"\+?[0-9][0-9 ()-]{8,}[0-9]"


@query(
    "raw_envelope_roundtrip",
    """
    SELECT event_id, user_id, value, props, 'events' AS topic, '2024-02-01' AS seen FROM events
    """,
)
def raw_envelope_roundtrip(t: Source) -> DataFrame:
    envelopes = to_envelope(t.events.select(*_EVENT), "events", "2024-02-01 07:00:00")
    rows = flatten(envelopes, T.StructType([T.StructField(n, T.StringType()) for n in _EVENT]))
    return rows.select(
        F.col("event_id").cast("long").alias("event_id"),
        F.col("user_id").cast("long").alias("user_id"),
        F.col("value").cast("double").alias("value"),
        F.get_json_object("json_data", "$.props").alias("props"),
        F.lit("events").alias("topic"),
        F.date_format("event_time", "yyyy-MM-dd").alias("seen"),
    )


@query(
    "raw_reject_split",
    """
    SELECT CASE event_type WHEN 'error' THEN 'unparseable json_data'
                           WHEN 'signup' THEN 'missing json_data' ELSE 'ok' END AS outcome,
           count(*) AS n, count(DISTINCT json_extract_string(props, '$.k'))
               FILTER (event_type NOT IN ('error', 'signup')) AS k_values
    FROM events GROUP BY 1
    """,
)
def raw_reject_split(t: Source) -> DataFrame:
    kind = F.col("event_type")
    cut = F.expr("substr(props, 1, length(props) - 1)")
    sent = t.events.select(
        F.when(kind == "error", cut).when(kind != "signup", F.col("props")).alias("json_data"),
        F.col("ts").alias("event_time"),
    )
    good, bad = split_valid(sent, T.StructType.fromDDL("k string"))
    both = good.select(F.lit("ok").alias("outcome"), F.col("doc.k").alias("k")).unionByName(
        bad.select(F.col("reason").alias("outcome"), F.lit(None).cast("string").alias("k"))
    )
    return both.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("k").alias("k_values")
    )


_JSON_CUSTOMERS = """
    SELECT ' CUS-' || c_custkey AS customer_id, r_name AS shop_country, n_name AS shop_city,
           c_nationkey::DOUBLE AS shop_latitude, ' ' || c_mktsegment || ' Lane' AS home_street,
           (c_custkey % 50)::VARCHAR AS home_house,
           md5(lower(c_name || '@example.com')) AS email,
           CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS last_name,
           '{"preferred_language":"en","preferred_payment_method":"Cash","receive_promotions":false}'
               AS preferences
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


@query("flatten_json_paths", _JSON_CUSTOMERS)
def flatten_json_paths(t: Source) -> DataFrame:
    good, _ = split_valid(retail.envelopes(t, "customers"), "customers")
    rows = flatten(good, "customers", missing="")
    preferences = F.from_json(
        F.get_json_object("json_data", "$.preferences"),
        "preferred_language string, preferred_payment_method string, receive_promotions boolean",
    )
    return rows.select(
        "customer_id",
        F.col("purchase_location_country").alias("shop_country"),
        F.col("purchase_location_city").alias("shop_city"),
        F.col("purchase_location_coordinates_latitude").cast("double").alias("shop_latitude"),
        F.col("delivery_address_street").alias("home_street"),
        F.col("delivery_address_house").alias("home_house"),
        "email",
        "last_name",
        as_json(preferences).alias("preferences"),
    )


@query(
    "items_exploded",
    """
    SELECT 'ORD-' || l_orderkey AS purchase_id, 'PRD-' || l_partkey AS product_id,
           l_quantity::INT AS quantity, l_extendedprice AS total_price
    FROM lineitem
    UNION ALL
    SELECT 'ORD-' || l_orderkey, 'GIFT-' || l_suppkey, 1, 0.0 FROM lineitem
    """,
)
def items_exploded(t: Source) -> DataFrame:
    return explode_items(retail.raw(t, "purchases"), keep=("purchase_id",)).select(
        "purchase_id",
        "product_id",
        F.col("quantity").cast("int").alias("quantity"),
        F.col("total_price").cast("double").alias("total_price"),
    )


@query(
    "items_first_only",
    """
    SELECT 'ORD-' || l_orderkey AS purchase_id, 'PRD-' || l_partkey AS product_id,
           l_quantity::INT AS quantity
    FROM lineitem
    """,
)
def items_first_only(t: Source) -> DataFrame:
    return retail.raw(t, "purchases").select(
        "purchase_id",
        F.col("items_product_id").alias("product_id"),
        F.col("items_quantity").cast("int").alias("quantity"),
    )


@query(
    "array_join_labels",
    "SELECT doc_id, md5(replace(text, ' ', ', ')) AS joined_md5 FROM documents",
)
def array_join_labels(t: Source) -> DataFrame:
    words = F.split("text", " ")
    return t.documents.select("doc_id", F.md5(join_labels(words)).alias("joined_md5"))


@query(
    "labels_extract_all",
    r"""
    WITH labels AS (
        SELECT lang, regexp_replace(trim(unnest(regexp_extract_all(
                   text, '([А-ЯЁA-Z][а-яё0-9\s&,]*|[A-Z][a-z0-9\s&,]*)', 1))), ',+$', '') AS label
        FROM documents)
    SELECT lang, label, count(*) AS n FROM labels WHERE label <> '' GROUP BY ALL
    """,
)
def labels_extract_all(t: Source) -> DataFrame:
    labels = drop_blank(tidy_labels(extract_labels(F.col("text"))))
    return (
        unnest(t.documents, labels, "label")
        .groupBy("lang", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "mask_email",
    rf"""
    SELECT doc_id, md5(lower(email)) AS email_md5, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{EMAIL}')) AS email FROM documents)
    GROUP BY ALL
    """,
)
def mask_email(t: Source) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(EMAIL), 0)
    # Looking for the one character every address has costs far less than the pattern.
    candidates = t.documents.filter(F.col("text").contains("@"))
    emails = unnest(candidates, found, "email")
    padded = F.concat(F.lit(" "), "email", F.lit("\n"))
    return emails.groupBy("doc_id", masked_email(padded).alias("email_md5")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "mask_phone",
    rf"""
    WITH found AS (
        SELECT doc_id, regexp_replace(
                   unnest(regexp_extract_all(text, '{PHONE}')), '[^0-9+]', '', 'g') AS p
        FROM documents)
    SELECT doc_id, md5(CASE WHEN p LIKE '8%' THEN '+7' || substr(p, 2)
                            WHEN p LIKE '7%' AND p NOT LIKE '%+%' THEN '+7' || substr(p, 2)
                            WHEN length(p) = 10 THEN '+7' || p ELSE p END) AS phone_md5,
           count(*) AS n
    FROM found GROUP BY ALL
    """,
)
def mask_phone(t: Source) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(PHONE), 0)
    phones = unnest(t.documents, found, "phone")
    return phones.groupBy("doc_id", masked_phone(F.col("phone")).alias("phone_md5")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "mask_nested",
    """
    SELECT c_custkey,
           md5(lower(c_name || '@mail.org')) AS email,
           md5('+7' || lpad(c_custkey::VARCHAR, 10, '0')) AS first_phone,
           CASE WHEN c_nationkey % 2 = 0 THEN '' ELSE md5('+7' || lpad(c_custkey::VARCHAR, 9, '1'))
                END AS second_phone,
           c_mktsegment AS note, c_acctbal AS phone_bill
    FROM customer
    """,
)
def mask_nested(t: Source) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    second = F.when(F.col("c_nationkey") % 2 == 0, "").otherwise(
        F.concat(F.lit("7 ("), F.lpad(key, 9, "1"), F.lit(")"))
    )
    docs = t.customer.select(
        "c_custkey",
        F.struct(
            F.struct(F.concat(F.lit(" "), "c_name", F.lit("@Mail.ORG")).alias("Email")).alias("web"),
            F.array(
                F.struct(F.concat(F.lit("8 "), F.lpad(key, 10, "0")).alias("work_phone")),
                F.struct(second.alias("work_phone")),
            ).alias("lines"),
            F.col("c_mktsegment").alias("note"),
        ).alias("contact"),
        F.col("c_acctbal").alias("phone_bill"),
    )
    return mask_fields(docs).select(
        "c_custkey",
        F.col("contact.web.Email").alias("email"),
        F.col("contact.lines")[0]["work_phone"].alias("first_phone"),
        F.col("contact.lines")[1]["work_phone"].alias("second_phone"),
        F.col("contact.note").alias("note"),
        "phone_bill",
    )


@query(
    "raw_monthly_partitions",
    """
    SELECT strftime(l_shipdate, '%Y%m') AS ym, count(*) AS row_count,
           sum(l_quantity)::DOUBLE AS quantity
    FROM lineitem GROUP BY 1
    """,
)
def raw_monthly_partitions(t: Source) -> DataFrame:
    path = scratch_dir(t.spark, "raw-monthly")
    write_raw(t.lineitem.select("l_shipdate", "l_quantity"), path, ts="l_shipdate")
    stored = t.spark.read.parquet(path)
    return stored.groupBy(F.col("ym").cast("string").alias("ym")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("l_quantity").alias("quantity")
    )


@query(
    "retention_filter",
    """
    SELECT o_orderkey, o_orderdate::DATE AS day FROM orders
    WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 360 DAY
    """,
)
def retention_filter(t: Source) -> DataFrame:
    newest = t.orders.agg(F.max("o_orderdate")).scalar()
    kept = retain(t.orders, "o_orderdate", 360, newest)
    return kept.select("o_orderkey", F.to_date("o_orderdate").alias("day"))


@query(
    "document_roundtrip",
    """
    SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'about ' || c_custkey ELSE c_custkey::VARCHAR END AS birth_date,
           'kept ' || c_mktsegment AS extra_note, c_nationkey::VARCHAR AS extra_nation,
           md5('+7' || lpad(c_custkey::VARCHAR, 10, '0')) AS phone,
           md5(lower(c_name || '@mail.org')) AS first_mail, md5(lower('b' || c_custkey || '@mail.org')) AS second_mail,
           md5('+7' || lpad(c_custkey::VARCHAR, 10, '1')) AS number_phone, c_comment AS comment
    FROM (SELECT *, 'say "phone": ' || c_name AS c_comment FROM customer)
    """,
)
def document_roundtrip(t: Source) -> DataFrame:
    """Documents with unknown fields and values of unexpected kinds, sent and read back whole."""
    base, key = scratch_dir(t.spark, "roundtrip"), F.col("c_custkey").cast("string")
    docs = t.customer.select(
        F.concat(F.lit("CUS-"), key).alias("customer_id"),
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('"about '), key, F.lit('"'))).otherwise(key).alias("birth"),
        F.to_json(F.struct(F.concat(F.lit('say "phone": '), "c_name").alias("comment"))).alias("comment"),
        "c_mktsegment", "c_nationkey", "c_name", "c_custkey",
    )
    text = F.format_string(
        '{"customer_id": "%s", "birth_date": %s, "extra": {"note": "kept %s", "list": [{"nation": %s, "Work_Phone": "8 (%s)"}]}, '
        '"web": {"emails": [" %s@Mail.org", "b%s@mail.org"]}, "phone": %s, "said": %s}',
        "customer_id", "birth", "c_mktsegment", F.col("c_nationkey").cast("string"), F.lpad(key, 10, "0"),
        "c_name", key, F.concat(F.lit("7"), F.lpad(key, 10, "1")), "comment",
    )
    docs.select(text.alias("value")).write.text(f"{base}/documents")
    read = read_documents(t.spark, f"{base}/documents", multi_line=False)
    sent = text_envelope(read, mask_json(F.col("text")), "customers", retail.RUN)
    write_envelopes(sent, f"{base}/envelopes")
    good, _ = split_valid(read_envelopes(t.spark, f"{base}/envelopes", ["customers"]), "customers")

    def at(path: str) -> Column:
        return F.get_json_object("json_data", f"$.{path}")

    return flatten(good, "customers").select(
        F.substring("customer_id", 5, 20).cast("long").alias("c_custkey"),
        "birth_date",
        at("extra.note").alias("extra_note"),
        at("extra.list[0].nation").alias("extra_nation"),
        at("extra.list[0].Work_Phone").alias("phone"),
        at("web.emails[0]").alias("first_mail"),
        at("web.emails[1]").alias("second_mail"),
        F.col("phone").alias("number_phone"),
        at("said.comment").alias("comment"),
    )
