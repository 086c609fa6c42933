"""Cleaning, typing, keys and predicates over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions import clean as c
from basketry.functions.dates import in_window, is_weekend, month_key, on_day
from basketry.operators.lookup import plausible_dates, require, split_valid_rows
from basketry.queries.registry import Source, query


@query(
    "clean_text",
    """
    SELECT doc_id,
           md5(coalesce(nullif(lower(trim(text)), ''), '')) AS text_md5,
           nullif(lower(trim('  ' || source || ' ')), 'src0') AS source_text,
           coalesce(nullif(trim(lang), 'en'), '') AS lang_or_blank
    FROM documents
    """,
)
def clean_text(t: Source) -> DataFrame:
    return t.documents.select(
        "doc_id",
        F.md5(c.or_blank(c.clean_text(F.col("text")))).alias("text_md5"),
        F.nullif(
            c.clean_text(F.concat(F.lit("  "), "source", F.lit(" "))), F.lit("src0")
        ).alias("source_text"),
        c.or_blank(F.nullif(c.clean_trim(F.col("lang")), F.lit("en"))).alias("lang_or_blank"),
    )


@query(
    "clean_labels",
    """
    SELECT p_partkey,
           lower(trim('🍏 ' || p_type)) AS marked,
           lower(p_type) AS anchored,
           lower(p_type || ' ' || p_brand) AS anywhere,
           lower(p_type || ' ' || regexp_replace(p_brand, '[^\\p{L}\\p{N}\\s,]+', '', 'g'))
               AS label
    FROM part
    """,
)
def clean_labels(t: Source) -> DataFrame:
    marked = F.concat(F.lit("🍏 "), "p_type")
    both = F.concat(marked, F.lit(" 🥖"), "p_brand")
    spaced = F.concat(marked, F.lit(" 🥖"), c.keep_word_chars(F.col("p_brand")))
    return t.part.select(
        "p_partkey",
        c.clean_text(marked).alias("marked"),
        c.clean_text(c.strip_emoji(marked, anchored=True)).alias("anchored"),
        c.clean_text(c.strip_emoji(both, literal=True)).alias("anywhere"),
        c.clean_label(spaced).alias("label"),
    )


@query(
    "clean_cast",
    """
    WITH raw AS (
        SELECT event_id,
               CASE WHEN event_type = 'error' THEN 'n/a' ELSE ' ' || value::VARCHAR || ' ' END
                   AS amount,
               CASE WHEN event_type = 'view' THEN '' ELSE json_extract_string(props, '$.k') END
                   AS k,
               CASE WHEN event_type = 'click' THEN strftime(ts, '%d.%m.%Y')
                    ELSE strftime(ts, '%Y-%m-%d') END AS day
        FROM events)
    SELECT event_id,
           try_cast(trim(amount) AS DOUBLE) AS amount_double,
           try_cast(trim(amount) AS DECIMAL(16,2)) AS amount_money,
           try_cast(nullif(k, '') AS INTEGER) AS k_int,
           coalesce(try_cast(nullif(k, '') AS INTEGER), 0) AS k_short,
           CASE WHEN day LIKE '____-__-__' THEN try_cast(day AS DATE) END AS day
    FROM raw
    """,
)
def clean_cast(t: Source) -> DataFrame:
    kind = F.col("event_type")
    raw = t.events.select(
        "event_id",
        F.when(kind == "error", "n/a")
        .otherwise(F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")))
        .alias("amount"),
        F.when(kind == "view", "").otherwise(F.get_json_object("props", "$.k")).alias("k"),
        F.when(kind == "click", F.date_format("ts", "dd.MM.yyyy"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
        .alias("day"),
    )
    return raw.select(
        "event_id",
        c.to_double(F.col("amount")).alias("amount_double"),
        c.to_money(F.col("amount")).alias("amount_money"),
        c.to_int(F.col("k")).alias("k_int"),
        c.to_short(F.col("k")).cast("int").alias("k_short"),
        c.to_date_or_null(F.col("day")).alias("day"),
    )


@query(
    "clean_flags",
    """
    SELECT o_orderkey,
           (o_orderstatus = 'F')::INT AS strict_flag,
           CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 1
                WHEN '3-MEDIUM' THEN 0 WHEN '4-NOT SPECIFIED' THEN 0 END AS open_flag,
           CASE o_orderstatus WHEN 'F' THEN 'male' WHEN 'O' THEN 'female' END AS word,
           CASE WHEN length(o_orderkey::VARCHAR) = 4 THEN o_orderkey::VARCHAR END AS code,
           NULL::VARCHAR AS nothing
    FROM orders
    """,
)
def clean_flags(t: Source) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    code = F.concat(F.lit(" "), F.col("o_orderkey").cast("string"))
    written = (
        F.when(priority == "1-URGENT", " YES")
        .when(priority == "2-HIGH", "1")
        .when(priority == "3-MEDIUM", "No ")
        .when(priority == "4-NOT SPECIFIED", "FALSE")
        .otherwise("maybe")
    )
    word = F.when(status == "F", "Male ").when(status == "O", "FEMALE").otherwise("unknown")
    return t.orders.select(
        "o_orderkey",
        c.to_bool(F.when(status == "F", " True").when(status == "O", "yes"))
        .cast("int")
        .alias("strict_flag"),
        c.to_bool3(written).cast("int").alias("open_flag"),
        c.to_enum(word, ("male", "female")).alias("word"),
        c.fixed_len(code, 4).alias("code"),
        c.null_of("string").alias("nothing"),
    )


@query(
    "clean_required_keys",
    """
    SELECT o_orderkey, nullif(lower(trim(o_orderstatus)), 'p') AS status
    FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
    """,
)
def clean_required_keys(t: Source) -> DataFrame:
    blanked = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "  ").otherwise(F.col("o_orderstatus")).alias("s"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"),
    )
    return require(blanked, "s", "p").select(
        "o_orderkey", c.clean_text(F.col("s")).alias("status")
    )


_TYPED_ORDERS = """
    WITH raw AS (
        SELECT o_orderkey::VARCHAR AS purchase_id,
               CASE WHEN o_custkey % 10 = 0 THEN ' ' ELSE o_custkey::VARCHAR END AS customer_id,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'abc' ELSE o_totalprice::VARCHAR END
                   AS total_amount,
               CASE WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN '31.31.2025'
                    ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS seen_at
        FROM orders),
    typed AS (
        SELECT purchase_id, nullif(trim(customer_id), '') AS customer_id,
               try_cast(total_amount AS DECIMAL(16,2)) AS total_amount,
               try_cast(seen_at AS TIMESTAMP) AS seen_at
        FROM raw)
"""


def _typed_orders(t: Source) -> DataFrame:
    odd = (F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 2 == 0)
    raw = t.orders.select(
        F.col("o_orderkey").cast("string").alias("purchase_id"),
        F.when(F.col("o_custkey") % 10 == 0, " ")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("customer_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", "abc")
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("total_amount"),
        F.when(odd, "31.31.2025")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .alias("seen_at"),
    )
    return raw.select(
        "purchase_id",
        c.clean_text(F.col("customer_id")).alias("customer_id"),
        c.to_money(F.col("total_amount")).alias("total_amount"),
        c.to_ts(F.col("seen_at")).alias("seen_at"),
    )


_REQUIRED = ("customer_id", "total_amount", "seen_at")


@query(
    "fact_purchases_valid",
    _TYPED_ORDERS
    + """
    SELECT purchase_id, customer_id, total_amount, strftime(seen_at, '%Y-%m-%d') AS day FROM typed
    WHERE customer_id IS NOT NULL AND total_amount IS NOT NULL AND seen_at IS NOT NULL
    """,
)
def fact_purchases_valid(t: Source) -> DataFrame:
    good, _ = split_valid_rows(_typed_orders(t), _REQUIRED)
    return good.select(
        "purchase_id", "customer_id", "total_amount", F.date_format("seen_at", "yyyy-MM-dd").alias("day")
    )


@query(
    "fact_purchases_rejects",
    _TYPED_ORDERS
    + """
    SELECT purchase_id,
           concat_ws(',', CASE WHEN customer_id IS NULL THEN 'customer_id' END,
                          CASE WHEN total_amount IS NULL THEN 'total_amount' END,
                          CASE WHEN seen_at IS NULL THEN 'seen_at' END) AS reason
    FROM typed
    WHERE customer_id IS NULL OR total_amount IS NULL OR seen_at IS NULL
    """,
)
def fact_purchases_rejects(t: Source) -> DataFrame:
    _, bad = split_valid_rows(_typed_orders(t), _REQUIRED)
    return bad.select("purchase_id", "reason")


@query(
    "plausibility_filter",
    """
    SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS registered
    FROM lineitem
    WHERE l_returnflag <> 'N'
      AND l_shipdate::DATE > DATE '1998-01-01' + (l_quantity::INT * 10)
    """,
)
def plausibility_filter(t: Source) -> DataFrame:
    birth = F.date_add(F.lit("1998-01-01").cast("date"), F.col("l_quantity").cast("int") * 10)
    rows = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.to_date("l_shipdate").alias("registered"),
        F.when(F.col("l_returnflag") != "N", birth).alias("birth"),
    )
    return plausible_dates(rows, "birth", "registered").drop("birth")


@query(
    "date_parts",
    """
    SELECT event_id, hour(ts)::INT AS hour, (isodow(ts) >= 6)::INT AS weekend,
           strftime(ts, '%Y%m') AS ym, ts::DATE AS day,
           (ts BETWEEN TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 14 DAY
                   AND TIMESTAMP '2024-01-30 12:00:00')::INT AS closed_14d,
           (ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 7 DAY)::INT AS open_7d,
           (ts::DATE = DATE '2024-01-30')::INT AS that_day
    FROM events
    """,
)
def date_parts(t: Source) -> DataFrame:
    ts, as_of = F.col("ts"), F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    return t.events.select(
        "event_id",
        F.hour(ts).alias("hour"),
        is_weekend(ts).cast("int").alias("weekend"),
        month_key(ts).alias("ym"),
        F.to_date(ts).alias("day"),
        in_window(ts, as_of, 14).cast("int").alias("closed_14d"),
        in_window(ts, as_of, 7, closed=False).cast("int").alias("open_7d"),
        on_day(ts, as_of).cast("int").alias("that_day"),
    )


@query(
    "surrogate_key_cardinality",
    """
    SELECT count(DISTINCT (coalesce(nullif(o_orderpriority, '5-LOW'), ''),
                           coalesce(nullif(o_orderstatus, 'P'), ''), o_totalprice)) AS keys,
           count(*) AS row_count
    FROM orders
    """,
)
def surrogate_key_cardinality(t: Source) -> DataFrame:
    key = c.surrogate_key(
        F.nullif("o_orderpriority", F.lit("5-LOW")),
        F.nullif("o_orderstatus", F.lit("P")),
        F.col("o_totalprice"),
    )
    return t.orders.agg(F.count_distinct(key).alias("keys"), F.count(F.lit(1)).alias("row_count"))


@query(
    "normalized_text",
    """
    SELECT doc_id, md5(nfc_normalize(text)) AS text_md5 FROM documents
    """,
)
def normalized_text(t: Source) -> DataFrame:
    return t.documents.select("doc_id", F.md5(c.nfc(F.col("text"))).alias("text_md5"))


@query(
    "dates_best_effort",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 9 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day
    FROM orders
    """,
)
def dates_best_effort(t: Source) -> DataFrame:
    """Order dates written in ten ways, the last of them no date at all."""
    day = F.col("o_orderdate").cast("timestamp")
    seconds = F.unix_seconds(day)
    late = F.dayofmonth(day) > 12
    ways = [
        F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        F.date_format(day, "yyyy/M/d HH:mm:ss"),
        F.date_format(day, "dd.MM.yyyy HH:mm"),
        F.when(late, F.date_format(day, "MM/dd/yyyy")).otherwise(F.date_format(day, "d/M/yyyy")),
        seconds.cast("string"),
        (seconds * 1000).cast("string"),
        F.date_format(day, "yyyyMMddHHmmss"),
        F.date_format(day, "d MMM yyyy"),
        F.date_format(day, "MMM d, yyyy"),
        F.date_format(day, "'week of' dd.MM.yyyy"),
    ]
    text = F.coalesce(*(F.when(F.col("o_orderkey") % 10 == i, w) for i, w in enumerate(ways)))
    spaced = F.concat(F.lit(" "), text, F.lit(" "))
    return t.orders.select("o_orderkey", F.date_format(c.best_effort_ts(spaced), "yyyy-MM-dd").alias("day"))
