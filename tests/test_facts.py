"""Facts, lookups, checks and metrics."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from roastery.functions import money_sum
from roastery.operators import dims, facts, quality
from roastery.operators.lookup import attach_key
from roastery.operators.metrics import marketing_performance, refresh_performance


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def star(spark):
    users = spark.createDataFrame(
        [("u1", "Ann", None, None), ("u2", "Bob", None, None)],
        "user_id string, full_name string, email string, phone string",
    )
    products = spark.createDataFrame(
        [("P1", "Mug", "1"), ("P2", "Mug", "2"), ("P3", "Hat", "3")],
        "p_code string, p_name string, retail_price string",
    )
    spend = spark.createDataFrame(
        [
            ("01/15/2026", "fb", "0.005"),
            ("15/01/2026", " FB ", "0.005"),
            ("15/01/2026", "facebook", "0.005"),
            ("16/01/2026", "tiktok", "20.10"),
            ("16/01/2026", "myspace", "99"),
            ("never", "fb", "99"),
            ("16/01/2026", "g_ads", "n/a"),
        ],
        "event_date string, platform string, cost string",
    )
    leads = spark.createDataFrame([("organic", "17/01/2026")], "source string, signup_date string")
    sales = spark.createDataFrame(
        [
            ("s1", " u1 ", "Mug ", "$10.00", "2026-01-15 09:00:00"),
            ("s2", "u9", "Hat", "€10", "2026-01-15"),
            ("s3", None, "Sofa", "-50", "2026-01-16 00:00:00"),
            ("s4", "UNKNOWN", None, "1-2", "2026-01-18 00:00:00"),
            ("s5", "u2", "Hat", "7", "yesterday"),
        ],
        "sale_id string, user_id string, product_name string, amount string, timestamp string",
    )
    visits = spark.createDataFrame([("2026-01-14 10:00:00",)], "ts string")
    return {
        "spend": spend,
        "sales": sales,
        "dim_user": dims.dim_user(users),
        "dim_product": dims.dim_product(products),
        "dim_platform": dims.dim_platform(spend, leads),
        "dim_date": dims.dim_date(*dims.calendar_dates(sales, visits, spend, leads)),
    }


def test_spend_is_rounded_once_per_total(spark, star):
    fact = facts.fact_ad_spend(star["spend"], star["dim_date"], star["dim_platform"])
    final, report = facts.finalize_ad_spend(fact, star["dim_date"], star["dim_platform"])
    platform = {r["platform"]: r["platform_key"] for r in star["dim_platform"].collect()}
    assert rows(final.select("date_key", "platform_key", "total_cost")) == sorted(
        [
            (20260115, platform["facebook"], Decimal("0.02")),
            (20260116, platform["tiktok"], Decimal("20.10")),
            (20260116, platform["google_ads"], None),
        ],
        key=repr,
    )
    assert final.select("ad_spend_key").distinct().count() == 3
    assert {r["fk"]: r["orphan_rows"] for r in report.collect()} == {"date_key": 0, "platform_key": 0}


@pytest.mark.parametrize("small", [True, False, None])
def test_sales_fall_back_and_never_fan_out(spark, star, small):
    fact = facts.fact_sales(
        star["sales"], star["dim_user"], star["dim_product"], small_users=small, small_products=small
    )
    assert rows(fact) == [
        ("s1", 20260115, 1, 1, Decimal("10.00")),
        ("s2", 20260115, 0, 3, Decimal("10.80")),
        ("s3", 20260116, 0, None, Decimal("0.00")),
        ("s4", 20260118, 0, None, None),
        ("s5", None, 2, 3, Decimal("7.00")),
    ]
    final, report = facts.finalize_sales(fact, star["dim_date"], star["dim_user"], star["dim_product"])
    assert [r["product_key"] for r in final.orderBy("sale_id").collect()] == [1, 3, -1, -1]
    found = {r["fk"]: (r["null_rows"], r["unmatched_rows"]) for r in report.collect()}
    assert found == {"date_key": (1, 0), "user_key": (0, 0), "product_key": (2, 0)}


def test_lookup_with_crowded_keys(spark):
    """A third of the rows on one member, a third without key, a tenth on a stranger."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit("m7"))
        .when(F.col("id") % 3 == 1, F.lit(None))
        .when(F.col("id") % 10 == 2, F.lit("stranger"))
        .otherwise(F.concat(F.lit("m"), F.col("id") % 5000))
    )
    crowd = spark.range(60000).select(F.col("id"), key.alias("member"))
    members = spark.range(4000).select(
        F.concat(F.lit("m"), "id").alias("member_id"), F.col("id").cast("int").alias("member_key")
    )
    doubled = members.union(members)
    shuffled = attach_key(crowd, doubled, F.col("member"), "member_id", "member_key", small=False)
    plain = crowd.join(members, F.col("member") == F.col("member_id"), "left").select("id", "member", "member_key")
    assert shuffled.count() == 60000
    assert shuffled.exceptAll(plain).isEmpty()
    assert plain.exceptAll(shuffled).isEmpty()
    assert attach_key(crowd, doubled, F.col("member"), "member_id", "member_key").exceptAll(plain).isEmpty()


def test_foreign_key_checks(spark):
    fact = spark.createDataFrame([(1,), (1,), (9,), (9,), (8,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (2,)], "id int")
    report = quality.check_fk(fact, dim, "k", "id").first().asDict()
    assert report == {
        "fk": "k",
        "fact_rows": 6,
        "null_rows": 1,
        "unmatched_rows": 3,
        "orphan_rows": 4,
        "unmatched_keys": 2,
    }
    good, bad = quality.check_fk(fact, dim, "k", "id", on_orphan="quarantine")
    assert rows(good) == [(1,), (1,)]
    assert rows(bad) == sorted([(9,), (9,), (8,), (None,)], key=repr)
    assert rows(quality.orphans(fact, dim, "k", "id")) == rows(bad)
    assert rows(quality.orphan_keys(fact, dim, "k", "id")) == sorted([(8, 1), (9, 2), (None, 1)], key=repr)
    with pytest.raises(quality.OrphanError):
        quality.check_fk(fact, dim, "k", "id", on_orphan="fail")
    assert quality.check_fk(good, dim, "k", "id", on_orphan="fail").first()["orphan_rows"] == 0
    with pytest.raises(ValueError):
        quality.check_fk(fact, dim, "k", "id", on_orphan="shrug")


def test_rejects_carry_each_reason(spark, star):
    sales = quality.sales_rejects(facts.clean_sales(star["sales"]))
    assert rows(sales.select("sale_id", "reason")) == [("s4", "bad_amount"), ("s5", "bad_timestamp")]
    spend = quality.spend_rejects(facts.clean_ad_spend(star["spend"]))
    assert rows(spend.select("platform", "reason")) == [
        ("fb", "bad_date"),
        ("g_ads", "bad_cost"),
        ("myspace", "unknown_platform"),
    ]


def test_unknown_members(spark, star):
    found = quality.unknown_members(star["sales"], "user_id", star["dim_user"], "user_id")
    assert rows(found) == [("u9",), (None,)] or rows(found) == [(None,), ("u9",)]


def _performance(spark, **options):
    sales = spark.createDataFrame(
        [
            (20260101, 1, Decimal("10.00")),
            (20260101, 1, Decimal("5.00")),
            (20260101, 0, Decimal("1.00")),
            (20260102, 0, Decimal("4.00")),
            (20260104, 2, Decimal("9.00")),
        ],
        "date_key int, user_key int, amount decimal(12,2)",
    )
    spend = spark.createDataFrame(
        [(20260101, Decimal("3.00")), (20260102, Decimal("0.00")), (20260103, Decimal("8.00"))],
        "date_key int, total_cost decimal(18,2)",
    )
    return marketing_performance(sales, spend, **options), sales, spend


def test_performance_ratios_and_one_sided_days(spark):
    daily, sales, spend = _performance(spark)
    found = {r["date_key"]: (r["total_ad_spend"], r["total_revenue"], r["paying_users"], r["roas"], r["cac"]) for r in daily.collect()}
    assert found == {
        20260101: (3, 16, 2, Decimal("5.3333"), Decimal("1.50")),
        20260102: (0, 4, 0, None, None),
        20260103: (8, None, None, None, None),
        20260104: (None, 9, 1, None, None),
    }
    touched = refresh_performance(sales, spend, [20260103, 20260104])
    assert sorted(r["date_key"] for r in touched.collect()) == [20260103, 20260104]
    assert refresh_performance(sales, spend, []).count() == 0


def test_distinct_payers_come_in_columns_of_their_own(spark):
    daily, _sales, _spend = _performance(spark, distinct_users=True)
    first = daily.where("date_key = 20260101").first()
    assert (first["paying_users"], first["distinct_paying_users"]) == (2, 1)
    assert (first["cac"], first["distinct_cac"]) == (Decimal("1.50"), Decimal("3.00"))


def test_calendar_covers_what_the_facts_parse(star):
    calendar = [r["full_date"] for r in star["dim_date"].orderBy("full_date").collect()]
    assert (calendar[0], calendar[-1]) == (dt.date(2026, 1, 14), dt.date(2026, 1, 18))


def test_money_sums_are_exact_and_of_the_plain_type(spark):
    values = [Decimal("0.01"), Decimal("-9999999999.99"), Decimal("9999999999.99"), None, Decimal("123.45")]
    narrow = spark.createDataFrame([(v,) for v in values * 50], "v decimal(12,2)")
    for df in (narrow, narrow.select(F.col("v").cast("decimal(20,4)").alias("v")), narrow.limit(0)):
        fast, plain = df.agg(money_sum(df, "v").alias("s")), df.agg(F.sum("v").alias("s"))
        assert fast.schema == plain.schema
        assert fast.collect() == plain.collect()
