"""Dimensions, surrogate keys and dedupe."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roastery import schemas
from roastery.operators import dims
from roastery.operators.keys import assign_keys, first_by_key, number_rows
from roastery.rules import Rules


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_first_by_key_is_smallest_with_nulls_last(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", "x", 3), ("a", "x", 2), ("b", None, None), (None, "q", 1), (None, "p", 9)],
        "k string, v string, n int",
    )
    expected = [("a", "x", 2), ("b", None, None), (None, "p", 9)]
    assert rows(first_by_key(df, "k")) == sorted(expected, key=repr)
    assert ("a", None, 1) in rows(first_by_key(df, "k", order=["n"]))


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_number_rows_equals_a_global_row_number(spark, coalesce):
    """Over one partition, as AQE leaves it for little data, and over several."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        _check_numbering(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _check_numbering(spark):
    df = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    keyed = number_rows(df.repartition(7), "k", "key", start=1)
    expected = {k: i + 1 for i, k in enumerate(sorted(r["k"] for r in df.collect()))}
    assert {r["k"]: r["key"] for r in keyed.collect()} == expected


def test_keys_survive_new_members(spark):
    def members(*names):
        return spark.createDataFrame([(n,) for n in names], "name string")

    first = assign_keys(members("m", "c", "x"), "name", "key", "bigint")
    second = assign_keys(members("a", "c", "x", "z"), "name", "key", "bigint", known=first)
    assert dict(rows(first.select("name", "key"))) == {"c": 1, "m": 2, "x": 3}
    # m is gone from the source, but facts may still point at it.
    assert dict(rows(second.select("name", "key"))) == {"a": 4, "c": 1, "m": 2, "x": 3, "z": 5}
    third = assign_keys(members("a", "c", "x", "z"), "name", "key", "bigint", known=second)
    assert rows(third.select("name", "key")) == rows(second.select("name", "key"))


def test_few_keys_follow_the_same_rule(spark):
    names = spark.createDataFrame([("facebook",), ("tiktok",)], "platform string")
    first = assign_keys(names, "platform", "platform_key", "int", few=True)
    more = names.union(spark.createDataFrame([("bing",)], "platform string"))
    second = assign_keys(more, "platform", "platform_key", "int", known=first, few=True)
    assert dict(rows(second.select("platform", "platform_key"))) == {"facebook": 1, "tiktok": 2, "bing": 3}


def test_dim_product(spark):
    raw = spark.createDataFrame(
        [("P2", " Mug ", "$19.99"), ("P1", "Mug", "1,299.00"), ("P1", "Cup", "5"), ("P3", "Hat", "")],
        "p_code string, p_name string, retail_price string",
    )
    assert rows(dims.dim_product(raw)) == rows(
        spark.createDataFrame(
            [
                (-1, "N/A", "Unknown Product", 0.0),
                (1, "P1", "Cup", 5.0),
                (2, "P2", "Mug", 19.99),
                (3, "P3", "Hat", None),
            ],
            "k long, c string, n string, p double",
        )
    )


def test_dim_user_rerun_keeps_one_unknown(spark):
    raw = spark.createDataFrame(
        [(" u1 ", " Ann ", "a@x ", "+1 (555) 010-2030"), ("u1", "Bob", None, "007"), ("u2", None, None, None)],
        "user_id string, full_name string, email string, phone string",
    )
    first = dims.dim_user(raw)
    expected = [(0, "UNKNOWN", "Unknown", None, None), (1, "u1", "Ann", "a@x", "15550102030"), (2, "u2", None, None, None)]
    assert rows(first) == sorted(expected, key=repr)
    assert rows(dims.dim_user(raw, known=first)) == sorted(expected, key=repr)


def test_dim_influencer_json(spark):
    raw = spark.createDataFrame(
        [
            ("i1", "r1", '{"handle":" @Shop","reach":5000}'),
            ("i2", "r2", '{"handle":"x","reach":"5000","rate":1}'),
            ("i3", "r3", '{"reach":5.5}'),
            ("i4", "r4", "not json"),
            ("i5", "r5", None),
            ("i1", "r9", '{"handle":"zz"}'),
        ],
        "inf_id string, ref_code string, metadata string",
    )
    assert [tuple(r) for r in dims.dim_influencer(raw).orderBy("inf_id").collect()] == [
        (1, "i1", "@shop", 5000, None, "r1"),
        (2, "i2", "x", None, 1.0, "r2"),
        (3, "i3", None, None, None, "r3"),
        (4, "i4", None, None, None, "r4"),
        (5, "i5", None, None, None, "r5"),
    ]


def test_calendar(spark):
    days = spark.createDataFrame([(dt.date(2026, 1, 30),), (None,)], "d date")
    more = spark.createDataFrame([(dt.date(2026, 2, 2),)], "other date")
    calendar = [tuple(r) for r in dims.dim_date(days, more).orderBy("full_date").collect()]
    assert calendar == [
        (dt.date(2026, 1, 30), 20260130, 2026, 1, "January", 30, 5, 1, 6, 0),
        (dt.date(2026, 1, 31), 20260131, 2026, 1, "January", 31, 5, 1, 7, 1),
        (dt.date(2026, 2, 1), 20260201, 2026, 2, "February", 1, 5, 1, 1, 1),
        (dt.date(2026, 2, 2), 20260202, 2026, 2, "February", 2, 6, 1, 2, 0),
    ]
    assert dims.dim_date(days.where("d is null")).count() == 0


def test_dim_platform_pools_both_sides(spark):
    spend = spark.createDataFrame([("fb",), ("TikTok",), ("myspace",), (None,)], "platform string")
    leads = spark.createDataFrame([("organic",), (None,), ("google_paid",)], "source string")
    assert rows(dims.dim_platform(spend, leads)) == [
        (1, "facebook"),
        (2, "google_ads"),
        (3, "organic"),
        (4, "other"),
        (5, "tiktok"),
    ]


def test_unknown_members_have_the_keys_of_the_rules(spark):
    rules = Rules(unknown_user_key=-5, unknown_product_key=-7)
    users = spark.createDataFrame([("u1", "Ann", None, None)], schemas.SOURCES["crm_users_export"])
    products = spark.createDataFrame([("P1", "Mug", "$1")], schemas.SOURCES["product_codes"])
    assert sorted(r["user_key"] for r in dims.dim_user(users, None, rules).collect()) == [-5, 1]
    assert sorted(r["product_key"] for r in dims.dim_product(products, None, rules).collect()) == [-7, 1]
    again = dims.dim_user(users, dims.dim_user(users, None, rules), rules)
    assert sorted(r["user_key"] for r in again.collect()) == [-5, 1]
    with pytest.raises(ValueError):
        Rules(unknown_user_key=3)
