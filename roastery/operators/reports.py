"""Report queries over the serving tables.  Each returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roastery.functions import date_of_key, money_sum, reaches
from roastery.rules import DEFAULT_RULES, Rules
from roastery.storage import materialize


def report_daily_performance(performance: DataFrame) -> DataFrame:
    """All days with missing spend, revenue and payers shown as zero, in order."""
    return (
        performance.where(F.col("date_key").isNotNull())
        .select(
            "date_key",
            date_of_key(F.col("date_key")).alias("date"),
            *[
                F.coalesce(F.col(c), F.lit(0)).alias(c)
                for c in ("total_ad_spend", "total_revenue", "paying_users")
            ],
            "roas",
            "cac",
        )
        .orderBy("date_key")
    )


def report_roas_by_platform(
    ad_spend: DataFrame, sales: DataFrame, dim_platform: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Spend per platform, with the return of the *whole* revenue on it; best first.

    Revenue is not attributed to platforms.  It is one number, taken in as a
    scalar subquery.  Spend is summed per key before the names are joined.
    """
    per_key = ad_spend.groupBy("platform_key").agg(F.sum("total_cost").alias("total_spend"))
    spend = (
        per_key.join(F.broadcast(dim_platform.select("platform_key", "platform")), "platform_key")
        .groupBy("platform")
        .agg(F.sum("total_spend").alias("total_spend"))
    )
    revenue = sales.agg(F.coalesce(money_sum(sales, "amount"), F.lit(0)).alias("revenue")).scalar()
    priced = spend.select(
        "platform", F.coalesce("total_spend", F.lit(0)).alias("total_spend"), revenue.alias("total_revenue")
    )
    roas = F.when(
        F.col("total_spend") > 0, F.round(F.col("total_revenue") / F.col("total_spend"), rules.roas_digits)
    ).otherwise(0)
    return priced.withColumn("roas", roas).orderBy(F.desc("roas"), "platform")


def report_platform_breakdown(roas_by_platform: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Platform, spend, ROAS and whether it reaches break-even."""
    return roas_by_platform.select(
        "platform", "total_spend", "roas", reaches(F.col("roas"), rules.breakeven).alias("profitable")
    )


def report_cac_over_time(performance: DataFrame) -> DataFrame:
    """Days that have an acquisition cost, in order."""
    return (
        performance.where(F.col("cac").isNotNull() & F.col("date_key").isNotNull())
        .orderBy("date_key")
        .select(
            date_of_key(F.col("date_key")).alias("date"),
            "cac",
            "total_ad_spend",
            F.coalesce("paying_users", F.lit(0)).alias("paying_users"),
        )
    )


def report_cac_summary(cac_over_time: DataFrame) -> DataFrame:
    """Lowest, mean and highest daily acquisition cost."""
    return cac_over_time.agg(
        F.min("cac").alias("min_cac"), F.avg("cac").alias("avg_cac"), F.max("cac").alias("max_cac")
    )


def report_sales_feed(
    sales: DataFrame,
    dim_user: DataFrame,
    dim_product: DataFrame,
    n: int | None = None,
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """The latest n sales with customer and product names.

    The top n are taken before any join and written as a scratch table of n rows,
    so the fact is read once though they serve three times: as the feed itself
    and to cut either dimension down to the members it needs.  (A cached frame
    would go stale when another application appends sales.)
    """
    newest_first = [F.desc("date_key"), F.desc("sale_id")]
    wanted = rules.feed_size if n is None else n
    latest = materialize(
        sales.where(F.col("date_key").isNotNull())
        .select("sale_id", "date_key", "user_key", "product_key", "amount")
        .orderBy(*newest_first)
        .limit(wanted),
        "feed",
    )

    def named(dim: DataFrame, key: str, name: str) -> DataFrame:
        keys = F.broadcast(latest.select(key).distinct())
        return dim.select(key, name).join(keys, key, "left_semi")

    return (
        latest.join(named(dim_user, "user_key", "full_name"), "user_key", "left")
        .join(named(dim_product, "product_key", "product_name"), "product_key", "left")
        .orderBy(*newest_first)
        .select(
            "sale_id",
            date_of_key(F.col("date_key")).alias("date"),
            F.coalesce("full_name", F.lit("Unknown")).alias("customer"),
            F.coalesce("product_name", F.lit("Unknown")).alias("product"),
            F.coalesce("amount", F.lit(0)).alias("amount"),
        )
    )


def report_daily_sales(sales: DataFrame) -> DataFrame:
    """Revenue and number of transactions per day, in order."""
    return (
        sales.where(F.col("date_key").isNotNull())
        .groupBy("date_key")
        .agg(money_sum(sales, "amount").alias("daily_revenue"), F.count("sale_id").alias("transactions"))
        .orderBy("date_key")
        .select(date_of_key(F.col("date_key")).alias("date"), "daily_revenue", "transactions")
    )


def report_kpis(performance: DataFrame) -> DataFrame:
    """Totals, unweighted means of the daily ratios, and the customer total."""

    def or_zero(value, name: str):
        return F.coalesce(value, F.lit(0)).alias(name)

    return performance.where(F.col("date_key").isNotNull()).agg(
        or_zero(F.sum("total_revenue"), "total_revenue"),
        or_zero(F.sum("total_ad_spend"), "total_spend"),
        or_zero(F.avg("roas"), "avg_roas"),
        or_zero(F.avg("cac"), "avg_cac"),
        or_zero(F.sum("paying_users"), "total_customers"),
    )


def report_overall_roas(kpis: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Total revenue over total spend (0 without spend); profitable only above break-even."""
    overall = F.when(F.col("total_spend") > 0, F.col("total_revenue") / F.col("total_spend")).otherwise(0)
    return kpis.select(
        "total_revenue",
        "total_spend",
        overall.alias("overall_roas"),
        reaches(overall, rules.breakeven, strict=True).alias("profitable"),
    )


def report_roas_trend(daily_performance: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Days that have a ROAS, and whether it reaches break-even."""
    return (
        daily_performance.dropna(subset=["roas"])
        .orderBy("date")
        .select("date", "roas", reaches(F.col("roas"), rules.breakeven).alias("profitable"))
    )


def report_total_sales(sales: DataFrame) -> DataFrame:
    """Number of sales."""
    return sales.agg(F.count(F.lit(1)).alias("total_sales"))
