"""Cleaning expressions against the expected values of the fixtures."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from roastery import functions as fn
from roastery.operators.facts import clean_sales
from roastery.rules import AD_PLATFORM_ALIASES, LEAD_SOURCE_ALIASES


def apply(spark, values, expression, kind="string"):
    """Evaluate a Column function on each value, in order."""
    frame = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("v"))).collect()]


def test_ambiguous_dates(spark):
    expected = {
        "01/15/2026": dt.date(2026, 1, 15),
        "15/01/2026": dt.date(2026, 1, 15),
        "03/01/2026": dt.date(2026, 1, 3),
        "01/02/2026": dt.date(2026, 1, 2),
        " 02/03/2026": dt.date(2026, 2, 3),
        "05/01/2026": dt.date(2026, 1, 5),
        "1/5/2026": dt.date(2026, 1, 5),
        "5/1/2026": None,
        "3/15/2026": None,
        "31/02/2026": None,
        "02/29/2026": None,
        "2026-01-15": None,
        "": None,
        None: None,
    }
    assert apply(spark, expected, fn.parse_ambiguous_date) == list(expected.values())


def test_month_cutoff_is_a_parameter(spark):
    assert apply(spark, ["05/01/2026"], lambda c: fn.parse_ambiguous_date(c, month_cutoff=12)) == [
        dt.date(2026, 5, 1)
    ]


MONEY = {
    "€100": ("EUR", "108.00"),
    "$ 1,234.565": ("USD", "1234.57"),
    "99.999": ("USD", "100.00"),
    "$2.675": ("USD", "2.68"),
    "-50": ("USD", "0.00"),
    "€-50": ("EUR", "0.00"),
    "-20": ("USD", "-20.00"),
    "": ("USD", None),
    "1-2": ("USD", None),
    "1.2.3": ("USD", None),
    "99999999999999": ("USD", None),
    None: ("USD", None),
}


def test_money(spark):
    rows = spark.createDataFrame([(a, "2026-01-01") for a in MONEY], "amount string, timestamp string")
    found = {r["amount"]: (r["currency"], r["amount_usd"]) for r in clean_sales(rows).collect()}
    assert found == {a: (c, None if v is None else Decimal(v)) for a, (c, v) in MONEY.items()}


def test_price_loses_its_sign_and_phone_keeps_digits_only(spark):
    assert apply(spark, ["$19.99", "1,299.00", "-5", "", "1.2.3", None], fn.price_of) == [
        19.99,
        1299.0,
        5.0,
        None,
        None,
        None,
    ]
    assert apply(spark, [" +1 (555) 010-2030", "007", "none", None], fn.digits_only) == [
        "15550102030",
        "007",
        "",
        None,
    ]


def test_aliases_drop_or_pool_the_unknown(spark):
    spellings = ["fb", " FB ", "facebã¶k", "G_Ads", "tiktok", "myspace", "", None]
    assert apply(spark, spellings, lambda c: fn.canonicalize(c, AD_PLATFORM_ALIASES)) == [
        "facebook",
        "facebook",
        "facebook",
        "google_ads",
        "tiktok",
        None,
        None,
        None,
    ]
    leads = ["fb_social", "google-ads", "Organic", "tiktok", "newsletter", None]
    assert apply(spark, leads, lambda c: fn.canonicalize(c, LEAD_SOURCE_ALIASES, "other")) == [
        "facebook",
        "google_ads",
        "organic",
        "other",
        "other",
        "other",
    ]


def test_timestamps_try_each_format(spark):
    texts = ["2026-01-15 10:30:00", "2026-01-15", "15.01.2026 10:30", "soon", None]
    day = dt.datetime(2026, 1, 15)
    assert apply(spark, texts, fn.parse_timestamp) == [day.replace(hour=10, minute=30), day, None, None, None]
    assert apply(spark, texts, lambda c: fn.parse_timestamp(c, ["dd.MM.yyyy HH:mm"]))[2] == day.replace(
        hour=10, minute=30
    )


def test_day_keys_there_and_back(spark):
    days = [dt.date(2026, 1, 5), dt.date(1999, 12, 31), None]
    keys = apply(spark, days, fn.day_key, "date")
    assert keys == [20260105, 19991231, None]
    assert apply(spark, keys, fn.date_of_key, "int") == days
    assert apply(spark, [20261301], fn.date_of_key, "int") == [None]


def test_weekend(spark):
    days = [dt.date(2026, 1, d) for d in (2, 3, 4, 5)]
    assert apply(spark, days, fn.weekend_flag, "date") == [0, 1, 1, 0]


@pytest.mark.parametrize(("strict", "expected"), [(False, [0, 1, 1, 0]), (True, [0, 0, 1, 0])])
def test_break_even_flags(spark, strict, expected):
    assert apply(spark, [0.5, 1.0, 1.5, None], lambda c: fn.reaches(c, 1.0, strict), "double") == expected


def test_one_of(spark):
    assert apply(spark, [1, 2, None], lambda c: fn.one_of("v", [2, 3]), "int") == [False, True, None]
    assert apply(spark, [1], lambda c: fn.one_of("v", []), "int") == [False]


def test_slash_dates_agree_with_the_formatter(spark):
    numbers = ["0", "1", "2", "01", "02", "09", "12", "13", "28", "29", "30", "31", "32", "001", "0015", "123", "", "x", "-1"]
    years = ["2026", "2024", "1900", "0000", "0001", "9999", "26", "12026", "2026 ", "2026-01-01", ""]
    texts = [f"{a}/{b}/{y}" for a in numbers for b in numbers for y in years]
    texts += ["", "/", "//", "1/1", "1/1/1/2026", "2026-01-15", "1-5-2026", "01/02/2026\n", "１/1/2026"]
    for date_format in ("M/d/yyyy", "dd/MM/yyyy"):
        fast = apply(spark, texts, lambda c: fn.parse_date(c, date_format).cast("string"))
        plain = apply(spark, texts, lambda c: F.try_to_date(c, date_format).cast("string"))
        assert [(t, a, b) for t, a, b in zip(texts, fast, plain) if a != b] == []
    assert apply(spark, ["2026.01.15"], lambda c: fn.parse_date(c, "yyyy.MM.dd")) == [dt.date(2026, 1, 15)]
