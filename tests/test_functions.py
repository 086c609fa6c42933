"""Expression units, malformed input included."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from support import values
from pyspark.sql import functions as F

from basketry.functions import clean as c
from basketry.functions import dates as d
from basketry.functions import masking as m
from basketry.operators.labels import drop_blank, extract_labels, tidy_labels

X = None


@pytest.fixture(autouse=True)
def column(spark):
    global X
    X = F.col("x")


def test_text(texts):
    df = texts(" МОСКВА ", "  ", "", None, "a B")
    assert values(df, c.clean_text(X)) == ["москва", None, None, None, "a b"]
    assert values(df, c.clean_trim(X)) == ["МОСКВА", None, None, None, "a B"]
    assert values(df, c.or_blank(X))[3] == ""


def test_emoji(texts):
    df = texts("🥖 Хлеб 🥖", "🍞 Хлеб", "Хлеб")
    assert values(df, c.strip_emoji(X)) == [" Хлеб ", " Хлеб", "Хлеб"]
    assert values(df, c.strip_emoji(X, anchored=True)) == [" Хлеб 🥖", " Хлеб", "Хлеб"]
    assert values(df, c.strip_emoji(X, literal=True)) == [" Хлеб ", "🍞 Хлеб", "Хлеб"]
    assert values(df, c.clean_label(X)) == ["хлеб"] * 3
    assert values(texts("a-б, 1!"), c.keep_word_chars(X)) == ["aб, 1"]
    assert values(texts("é"), c.nfc(X)) == ["é"]


def test_numbers(texts):
    df = texts(" 12.5 ", "abc", "", None, "12.345", "12.349", "-0.999")
    assert values(df, c.to_double(X))[:4] == [12.5, None, None, None]
    assert values(df, c.to_money(X)) == [
        Decimal("12.50"), None, None, None, Decimal("12.34"), Decimal("12.34"), Decimal("-0.99"),
    ]
    whole = texts("7", "70000", "x", None)
    assert values(whole, c.to_short(X)) == [7, 0, 0, 0]
    assert values(whole, c.to_short(X, default=None)) == [7, None, None, None]
    assert values(whole, c.to_int(X)) == [7, 70000, None, None]
    assert values(texts("1.5"), c.to_float(X)) == [1.5]


def test_strict_money_fails(texts):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(texts("abc"), c.to_money(X, strict=True))


def test_dates(texts):
    df = texts("2025-01-31", "31.31.2025", "", None)
    assert values(df, c.to_date_or_null(X)) == [date(2025, 1, 31), None, None, None]
    moments = texts("2025-01-04T12:41:38.359845", "2025-01-04T12:41:38Z", "31.31.2025", "")
    assert values(moments, F.date_format(c.to_ts(X), "yyyy-MM-dd HH:mm:ss.SSSSSS")) == [
        "2025-01-04 12:41:38.359845", "2025-01-04 12:41:38.000000", None, None,
    ]


def test_words(texts):
    df = texts("True ", "yes", "0", "NO", "maybe", None)
    assert values(df, c.to_bool(X)) == [True, False, False, False, False, False]
    assert values(df, c.to_bool3(X)) == [True, True, False, False, None, None]
    assert values(texts("Male", "x"), c.to_enum(X, ("male", "female"))) == ["male", None]
    assert values(texts(" 123456 ", "12345"), c.fixed_len(X, 6)) == ["123456", None]


def test_surrogate_key_keeps_null_positions(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "")], "p string, q string")
    keys = [r[0] for r in df.select(c.surrogate_key(F.col("p"), F.col("q"))).collect()]
    assert keys[0] != keys[1] and keys[0] == keys[2]


def test_windows(texts):
    as_of = datetime(2024, 1, 31, 12)
    df = texts(datetime(2024, 1, 1, 12), datetime(2024, 1, 1, 11), datetime(2024, 2, 1),
               kind="timestamp")
    assert values(df, d.in_window(X, as_of, 30)) == [True, False, False]
    assert values(df, d.in_window(X, as_of, 30, closed=False)) == [True, False, True]
    assert values(df, d.on_day(X, datetime(2024, 1, 1, 5))) == [True, True, False]


def test_week(texts):
    week = texts(*(datetime(2024, 1, day) for day in range(1, 8)), kind="timestamp")
    assert values(week, d.is_weekend(X)) == [False] * 5 + [True] * 2
    assert values(week, d.is_weekday(X)) == [True] * 5 + [False] * 2
    assert values(week, d.sunday_to_thursday(X)) == [True] * 4 + [False, False, True]


def test_event_time(texts):
    run = datetime(2024, 1, 1)
    got = values(texts("2024-05-01T00:00:00", "?", None), d.parse_event_time(X, run))
    assert got == [datetime(2024, 5, 1), run, run]


@pytest.mark.parametrize(
    ("phone", "normal", "md5"),
    [
        ("8 (320) 553-06-07", "+73205530607", "2047e3ff5219f099bac083a2e4c11b02"),
        ("+73258867793", "+73258867793", "df495a907f3c3e47c6de21ac589163f1"),
        ("9161234567", "+79161234567", "92cc5dce01b97390403d4a9c3fcd6931"),
        ("7916123-45-67", "+79161234567", "92cc5dce01b97390403d4a9c3fcd6931"),
        ("+7 (539) 098-74-36", "+75390987436", "b3d2f872bb6b356b07028343d3349365"),
    ],
)
def test_phone_vectors(texts, phone, normal, md5):
    assert values(texts(phone), m.normalize_phone(X)) == [normal]
    assert values(texts(phone), m.mask_phone(X)) == [md5]


def test_phone_edges(texts):
    # Eight takes the first rule even with ten digits; a 7 with a later plus stays as it is.
    df = texts("8123456789", "7+12", "123", "", None, "abc")
    assert values(df, m.normalize_phone(X)) == ["+7123456789", "7+12", "123", "", None, ""]
    assert values(df, m.mask_phone(X))[3:] == ["", None, ""]


def test_email_vector(texts):
    df = texts(" Vikenti1988@Example.com\n", "")
    assert values(df, m.mask_email(X)) == ["8200ad45bbc27d475da28f78feeb43be", ""]


def test_labels(texts):
    df = texts(" Мясо, рыба, яйца и бобовые,  Фрукты и ягоды", "")
    labels = drop_blank(tidy_labels(extract_labels(X)))
    assert values(df, labels) == [["Мясо, рыба, яйца и бобовые", "Фрукты и ягоды"], []]


def test_best_effort_moments(texts):
    cases = {
        "2025-04-03T10:20:30.5": "2025-04-03 10:20:30", "2025-04-03": "2025-04-03 00:00:00", "2025/4/3 1:02": "2025-04-03 01:02:00",
        "03/04/2025": "2025-04-03 00:00:00", "03/25/2025 10:11:12": "2025-03-25 10:11:12", "3.4.2025": "2025-04-03 00:00:00",
        "31-12-2024T23:59": "2024-12-31 23:59:00", "1743638400": "2025-04-03 00:00:00", "1743638400123": "2025-04-03 00:00:00",
        "1743638400123456": "2025-04-03 00:00:00", "20250403": "2025-04-03 00:00:00", "20250403101112": "2025-04-03 10:11:12",
        "3 Apr 2025": "2025-04-03 00:00:00", "Apr 3, 2025 04:05": "2025-04-03 04:05:00", " 2025-04-03T10:20:30Z ": "2025-04-03 10:20:30",
        "31.31.2025": None, "25/13/2025": None, "30.02.2025": None, "12": None, "soon": None, "": None, None: None, "2025-13-01": None,
    }
    assert values(texts(*cases), F.date_format(c.best_effort_ts(X), "yyyy-MM-dd HH:mm:ss")) == list(cases.values())
