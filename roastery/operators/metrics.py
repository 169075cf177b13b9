"""Daily marketing performance: return on ad spend and customer acquisition cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roastery import schemas
from roastery.functions import money_sum, one_of, ratio
from roastery.rules import DEFAULT_RULES, Rules


def daily_measures(sales: DataFrame, rules: Rules = DEFAULT_RULES, distinct_users: bool = False) -> DataFrame:
    """Revenue, sales by known users and, if asked, different known users per day.

    Without the distinct users the measures of parts of the sales add up to those of all.
    """
    known = F.col("user_key") != rules.unknown_user_key
    measures = [money_sum(sales, "amount").alias("total_revenue"), F.count_if(known).alias("paying_users")]
    if distinct_users:
        measures.append(F.count_distinct(F.when(known, F.col("user_key"))).alias("distinct_paying_users"))
    return sales.groupBy("date_key").agg(*measures)


def add_up(measures: DataFrame) -> DataFrame:
    """One row per day from measures of parts of its sales."""
    return measures.groupBy("date_key").agg(
        F.sum("total_revenue").cast(schemas.MEASURES["total_revenue"].dataType).alias("total_revenue"), F.sum("paying_users").alias("paying_users")
    )


def performance_of(revenue: DataFrame, spend: DataFrame, rules: Rules = DEFAULT_RULES, distinct_users: bool = False) -> DataFrame:
    """Daily performance from the measures of the sales, a row per day, and the spend."""
    cost = spend.groupBy("date_key").agg(F.sum("total_cost").alias("total_ad_spend"))
    daily = cost.join(revenue, "date_key", "full").withColumns(
        {
            "perf_key": F.col("date_key").cast("bigint"),
            "roas": ratio(F.col("total_revenue"), F.col("total_ad_spend"), rules.roas_digits),
            "cac": ratio(F.col("total_ad_spend"), F.col("paying_users"), rules.cac_digits),
        }
    )
    columns = schemas.STAR["fact_marketing_performance"].fieldNames()
    if not distinct_users:
        return daily.select(*columns)
    distinct_cac = ratio(F.col("total_ad_spend"), F.col("distinct_paying_users"), rules.cac_digits)
    return daily.withColumn("distinct_cac", distinct_cac).select(*columns, "distinct_paying_users", "distinct_cac")


def marketing_performance(
    sales: DataFrame,
    spend: DataFrame,
    rules: Rules = DEFAULT_RULES,
    distinct_users: bool = False,
) -> DataFrame:
    """One row per day with spend, revenue or both.

    Each side is reduced to one row per day before the outer join, with partial
    sums on the map side, so a day that holds a third of all sales costs its
    final task one row per map task.  ``paying_users`` counts sales by known
    users; ``distinct_users`` adds the number of different ones.
    """
    return performance_of(daily_measures(sales, rules, distinct_users), spend, rules, distinct_users)


def refresh_performance(
    sales: DataFrame, spend: DataFrame, date_keys: list[int], rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """The daily metrics of the given days only.

    The days are literals in the filter, so on facts partitioned by day the
    scans open just these partitions.
    """
    touched = one_of("date_key", date_keys)
    return marketing_performance(sales.where(touched), spend.where(touched), rules)
