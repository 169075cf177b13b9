"""The five conformed dimensions."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roastery import schemas
from roastery.functions import (
    canonicalize,
    day_key,
    digits_only,
    normalized,
    parse_ambiguous_date,
    parse_timestamp,
    price_of,
    weekend_flag,
)
from roastery.operators.keys import assign_keys, first_by_key, one_row
from roastery.rules import DEFAULT_RULES, UNKNOWN_PRODUCT, UNKNOWN_USER, Rules
from roastery.storage import read_table, side_by_side, write_table


def dim_product(products: DataFrame, known: DataFrame | None = None, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per product code, plus the unknown product."""
    cleaned = products.select(
        F.col("p_code").alias("product_code"),
        F.trim("p_name").alias("product_name"),
        price_of(F.col("retail_price")).alias("retail_price"),
    )
    keyed = assign_keys(
        first_by_key(cleaned, "product_code"), "product_code", "product_key", "bigint", known
    )
    keyed = schemas.conform(keyed, "dim_product")
    return keyed.unionByName(one_row(keyed, (rules.unknown_product_key, *UNKNOWN_PRODUCT[1:])))


def ad_platforms(ad_spend: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Canonical ad platform per spend row; NULL for a spelling nobody listed."""
    return ad_spend.select(canonicalize(F.col("platform"), rules.ad_platform_aliases).alias("platform"))


def lead_sources(leads: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Canonical source per lead; unlisted and missing sources count as other."""
    return leads.select(
        canonicalize(F.col("source"), rules.lead_source_aliases, rules.other_source).alias("platform")
    )


def dim_platform(
    ad_spend: DataFrame,
    leads: DataFrame,
    rules: Rules = DEFAULT_RULES,
    known: DataFrame | None = None,
) -> DataFrame:
    """Every canonical platform seen on either side; its size is bounded by the alias lists.

    Spellings are made distinct before they are read.
    """
    names = (
        ad_platforms(ad_spend.select("platform").distinct(), rules)
        .union(lead_sources(leads.select("source").distinct(), rules))
        .where(F.col("platform").isNotNull())
        .distinct()
    )
    return schemas.conform(
        assign_keys(names, "platform", "platform_key", "int", known, few=True), "dim_platform"
    )


def calendar_dates(
    sales: DataFrame,
    interactions: DataFrame,
    ad_spend: DataFrame,
    leads: DataFrame,
    rules: Rules = DEFAULT_RULES,
) -> list[DataFrame]:
    """One date column per source, read with the same parsers as the facts.

    Day texts repeat, so each is parsed once; timestamps hardly do.
    """

    def messy(df: DataFrame, column: str) -> DataFrame:
        parsed = parse_ambiguous_date(
            F.col(column), rules.month_cutoff, rules.month_first_format, rules.day_first_format
        )
        return df.select(column).distinct().select(parsed.alias("day"))

    def stamped(df: DataFrame, column: str) -> DataFrame:
        return df.select(F.to_date(parse_timestamp(F.col(column), rules.timestamp_formats)).alias("day"))

    return [
        stamped(sales, "timestamp"),
        stamped(interactions, "ts"),
        messy(ad_spend, "event_date"),
        messy(leads, "signup_date"),
    ]


def new_days(days: DataFrame, known: DataFrame) -> DataFrame:
    """Calendar rows of the dates in ``full_date`` that ``known`` lacks: those dates alone, no gaps filled."""
    missing = days.where(F.col("full_date").isNotNull()).distinct()
    return calendar_rows(missing.join(known.select("full_date"), "full_date", "left_anti"))


def new_platforms(names: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of the canonical names in ``platform`` that ``known`` lacks, numbered after its largest key."""
    present = names.where(F.col("platform").isNotNull()).distinct()
    keyed = assign_keys(present, "platform", "platform_key", "int", known, few=True)
    return schemas.conform(keyed.join(known.select("platform"), "platform", "left_anti"), "dim_platform")


def dim_date(*dates: DataFrame) -> DataFrame:
    """Gap-free calendar over all given one-column date frames.

    A single aggregate finds both bounds and the days are generated within the
    same plan, so nothing visits the driver.  No dates at all: an empty calendar.
    """
    pooled = reduce(DataFrame.union, [d.toDF("day") for d in dates])
    bounds = pooled.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    days = bounds.where(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("full_date")
    )
    return calendar_rows(days)


def calendar_rows(days: DataFrame) -> DataFrame:
    """Rows of the calendar for the dates in ``full_date``."""
    day = F.col("full_date")
    return schemas.conform(
        days.select(
            day,
            day_key(day).alias("date_key"),
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.dayofmonth(day).alias("day"),
            F.weekofyear(day).alias("week_of_year"),
            F.quarter(day).alias("quarter"),
            F.dayofweek(day).alias("day_of_week"),
            weekend_flag(day).alias("is_weekend"),
        ),
        "dim_date",
    )


def dim_user(users: DataFrame, known: DataFrame | None = None, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per user id, plus the unknown user."""
    cleaned = users.select(
        F.trim("user_id").alias("user_id"),
        F.trim("full_name").alias("full_name"),
        F.trim("email").alias("email"),
        digits_only(F.col("phone")).alias("phone"),
    )
    keyed = assign_keys(first_by_key(cleaned, "user_id"), "user_id", "user_key", "int", known)
    keyed = schemas.conform(keyed, "dim_user")
    return keyed.unionByName(one_row(keyed, (rules.unknown_user_key, *UNKNOWN_USER[1:])))


def flatten_influencers(campaigns: DataFrame) -> DataFrame:
    """Campaign rows with the JSON metadata as columns; what does not parse is NULL."""
    parsed = campaigns.select(
        "inf_id", "ref_code", F.from_json("metadata", schemas.INFLUENCER_METADATA).alias("meta")
    )
    return parsed.select(
        "inf_id",
        normalized(F.col("meta.handle")).alias("handle"),
        F.col("meta.reach").alias("reach"),
        F.col("meta.rate").alias("rate"),
        "ref_code",
    )


def dim_influencer(campaigns: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per influencer id."""
    members = first_by_key(flatten_influencers(campaigns), "inf_id")
    return schemas.conform(
        assign_keys(members, "inf_id", "influencer_key", "bigint", known), "dim_influencer"
    )


def promote_dims(
    spark: SparkSession,
    names: Iterable[str],
    src: str,
    dst: str,
    label: Callable[[str, DataFrame], DataFrame] | None = None,
) -> dict[str, int]:
    """Copy finished dimensions to the serving layer; returns rows per table.

    ``label`` may add or change columns of a dimension on the way.
    """

    def copy(name: str) -> int:
        table = read_table(spark, f"{src}/{name}")
        return write_table(table if label is None else label(name, table), f"{dst}/{name}")

    return side_by_side(spark, {name: partial(copy, name) for name in names})
