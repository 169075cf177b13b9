"""Ad-spend and sales facts: cleaning, conforming and finalizing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roastery import schemas
from roastery.functions import (
    canonicalize,
    currency_of,
    day_key,
    numeric_of,
    parse_ambiguous_date,
    parse_timestamp,
    to_usd,
)
from roastery.operators.lookup import attach_key
from roastery.operators.quality import fk_report
from roastery.rules import DEFAULT_RULES, Rules

# Costs add up exactly at this scale; the total, not the row, is rounded to cents.
COST = "decimal(20,6)"
TOTAL = "decimal(18,2)"
# Room for this many platforms per day in the spend key.
PLATFORM_SLOTS = 100_000


def clean_grain(ad_spend: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Add ``platform_clean`` and ``spend_date``, NULL where the text says nothing known."""
    return ad_spend.withColumns(
        {
            "platform_clean": canonicalize(F.col("platform"), rules.ad_platform_aliases),
            "spend_date": parse_ambiguous_date(
                F.col("event_date"), rules.month_cutoff, rules.month_first_format, rules.day_first_format
            ),
        }
    )


def clean_ad_spend(ad_spend: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Source rows plus ``platform_clean``, ``spend_date`` and ``cost_clean``."""
    return clean_grain(ad_spend, rules).withColumn("cost_clean", F.col("cost").try_cast(COST))


def spend_per_day(cleaned: DataFrame, *more_keys: str) -> DataFrame:
    """Total cost per canonical platform and day; unusable rows are left out."""
    usable = cleaned.where(F.col("platform_clean").isNotNull() & F.col("spend_date").isNotNull())
    return usable.groupBy("spend_date", "platform_clean", *more_keys).agg(
        F.sum("cost_clean").try_cast(TOTAL).alias("total_cost")
    )


def resolve_spend(daily: DataFrame, dim_date: DataFrame, dim_platform: DataFrame) -> DataFrame:
    """Replace day and platform name by their keys, NULL where unresolved.

    Both dimensions are bounded whatever the data volume, one by the number of
    days and one by the alias lists, so both are broadcast.
    """
    days = dim_date.select("full_date", "date_key")
    platforms = dim_platform.select(F.lower(F.trim("platform")).alias("platform"), "platform_key")
    return (
        daily.join(F.broadcast(days), F.col("spend_date") == F.col("full_date"), "left")
        .join(F.broadcast(platforms), F.col("platform_clean") == F.col("platform"), "left")
    )


def fact_ad_spend(
    ad_spend: DataFrame,
    dim_date: DataFrame,
    dim_platform: DataFrame,
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """date_key, platform_key, total_cost: one row per platform and day.

    Costs are first added up per spelling of day and platform, which are few
    however many rows there are, so texts are parsed once per spelling.
    """
    per_text = ad_spend.groupBy("event_date", "platform").agg(
        F.sum(F.col("cost").try_cast(COST)).alias("cost_clean")
    )
    daily = spend_per_day(clean_grain(per_text, rules))
    return resolve_spend(daily, dim_date, dim_platform).select("date_key", "platform_key", "total_cost")


def with_spend_key(fact: DataFrame) -> DataFrame:
    """Complete grains only, keyed by the grain itself: the same on every run and replay."""
    complete = fact.where(F.col("date_key").isNotNull() & F.col("platform_key").isNotNull())
    grain = F.col("date_key").cast("bigint") * PLATFORM_SLOTS + F.col("platform_key")
    return schemas.conform(complete.withColumn("ad_spend_key", grain), "fact_ad_spend")


def finalize_ad_spend(
    fact: DataFrame, dim_date: DataFrame, dim_platform: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Serving-layer spend fact, and the report on its foreign keys."""
    report = fk_report(
        fact, {"date_key": (dim_date, "date_key"), "platform_key": (dim_platform, "platform_key")}
    )
    return with_spend_key(fact), report


def clean_sales(sales: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Source rows plus ``currency``, ``amount_numeric``, ``amount_usd``, ``parsed_ts``, ``date_key``."""
    priced = sales.withColumns(
        {
            "currency": currency_of(F.col("amount")),
            "amount_numeric": numeric_of(F.col("amount")),
            "parsed_ts": parse_timestamp(F.col("timestamp"), rules.timestamp_formats),
        }
    )
    return priced.withColumns(
        {
            "amount_usd": to_usd(
                F.col("amount_numeric"), F.col("currency"), rules.eur_to_usd, rules.void_amount
            ),
            "date_key": day_key(F.to_date("parsed_ts")),
        }
    )


def resolve_sales(
    cleaned: DataFrame,
    dim_user: DataFrame,
    dim_product: DataFrame,
    rules: Rules = DEFAULT_RULES,
    small_users: bool | None = None,
    small_products: bool | None = None,
    pending: bool = False,
) -> DataFrame:
    """Sales with user_key (unknown user where unmatched) and product_key (NULL where unmatched).

    User ids are trimmed like those of the dimension, and products are looked
    up by a name that is made unique first, so each sale stays one row.  ``pending``
    adds the names that had no match, as ``pending_user`` and ``pending_product``.
    """
    slim = cleaned.select(
        "sale_id", "date_key", "user_id", "product_name", F.col("amount_usd").alias("amount")
    )
    users = attach_key(slim, dim_user, F.trim("user_id"), "user_id", "user_key", small_users)
    products = attach_key(
        users, dim_product, F.trim("product_name"), "product_name", "product_key", small_products
    )
    unmatched = {
        "pending_user": F.when(F.col("user_key").isNull(), F.trim("user_id")),
        "pending_product": F.when(F.col("product_key").isNull(), F.trim("product_name")),
    }
    known = products.withColumns({**(unmatched if pending else {}), "user_key": F.coalesce("user_key", F.lit(rules.unknown_user_key))})
    return schemas.conform(known, "fact_sales", *(unmatched if pending else ()))


def rekey_sales(sales: DataFrame, dim_user: DataFrame, dim_product: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Stored sales with the keys of members that came after them; what still has no match stays pending."""
    columns = sales.columns
    users = attach_key(sales.withColumnRenamed("user_key", "_user"), dim_user, F.col("pending_user"), "user_id", "user_key")
    users = users.withColumns(
        {"pending_user": F.when(F.col("user_key").isNull(), F.col("pending_user")), "user_key": F.coalesce("user_key", "_user")}
    ).drop("_user")
    found = attach_key(users.withColumnRenamed("product_key", "_product"), dim_product, F.col("pending_product"), "product_name", "product_key")
    found = found.withColumns(
        {"pending_product": F.when(F.col("product_key").isNull(), F.col("pending_product")), "product_key": F.coalesce("product_key", "_product")}
    )
    return found.select(*columns)


def fact_sales(
    sales: DataFrame,
    dim_user: DataFrame,
    dim_product: DataFrame,
    rules: Rules = DEFAULT_RULES,
    small_users: bool | None = None,
    small_products: bool | None = None,
) -> DataFrame:
    """sale_id, date_key, user_key, product_key, amount: one row per sale."""
    return resolve_sales(
        clean_sales(sales, rules), dim_user, dim_product, rules, small_users, small_products
    )


def with_product_fallback(fact: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Dated sales only, with the unknown product where none matched; columns beside the fact's stay."""
    dated = fact.where(F.col("date_key").isNotNull())
    more = [c for c in fact.columns if c not in schemas.STAR["fact_sales"].fieldNames()]
    return schemas.conform(
        dated.withColumn("product_key", F.coalesce("product_key", F.lit(rules.unknown_product_key))), "fact_sales", *more
    )


def finalize_sales(
    fact: DataFrame,
    dim_date: DataFrame,
    dim_user: DataFrame,
    dim_product: DataFrame,
    rules: Rules = DEFAULT_RULES,
) -> tuple[DataFrame, DataFrame]:
    """Serving-layer sales fact, and the report on its foreign keys before the fallback."""
    report = fk_report(
        fact,
        {
            "date_key": (dim_date, "date_key"),
            "user_key": (dim_user, "user_key"),
            "product_key": (dim_product, "product_key"),
        },
    )
    return with_product_fallback(fact, rules), report
