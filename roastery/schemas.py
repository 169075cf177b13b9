"""Declared schemas: raw sources (all text) and the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}


def _columns(**types) -> T.StructType:
    """Columns by name; a (precision, scale) pair stands for a decimal."""
    return T.StructType(
        [
            T.StructField(name, T.DecimalType(*kind) if isinstance(kind, tuple) else _TYPES[kind])
            for name, kind in types.items()
        ]
    )


SOURCES = {
    "product_codes": _text("p_code", "p_name", "retail_price"),
    "daily_ad_spend": _text("event_date", "platform", "cost"),
    "raw_web_leads": _text("source", "signup_date"),
    "sales_dump": _text("sale_id", "user_id", "product_name", "amount", "timestamp"),
    "website_interactions": _text("ts"),
    "crm_users_export": _text("user_id", "full_name", "email", "phone"),
    "influencer_campaigns": _text("inf_id", "ref_code", "metadata"),
}

INFLUENCER_METADATA = _columns(handle="string", reach="int", rate="double")

STAR = {
    "dim_product": _columns(
        product_key="bigint", product_code="string", product_name="string", retail_price="double"
    ),
    "dim_platform": _columns(platform_key="int", platform="string"),
    "dim_date": _columns(
        full_date="date",
        date_key="int",
        year="int",
        month="int",
        month_name="string",
        day="int",
        week_of_year="int",
        quarter="int",
        day_of_week="int",
        is_weekend="int",
    ),
    "dim_user": _columns(
        user_key="int", user_id="string", full_name="string", email="string", phone="string"
    ),
    "dim_influencer": _columns(
        influencer_key="bigint", inf_id="string", handle="string", reach="int", rate="double", ref_code="string"
    ),
    "fact_ad_spend": _columns(
        ad_spend_key="bigint", date_key="int", platform_key="int", total_cost=(18, 2)
    ),
    "fact_sales": _columns(
        sale_id="string", date_key="int", user_key="int", product_key="bigint", amount=(12, 2)
    ),
    "fact_marketing_performance": _columns(
        perf_key="bigint",
        date_key="int",
        total_ad_spend=(28, 2),
        total_revenue=(22, 2),
        paying_users="bigint",
        roas=(27, 4),
        cac=(27, 2),
    ),
}

# What a day's sales add to its metrics; measures of parts of the sales add up.
MEASURES = _columns(date_key="int", total_revenue=(22, 2), paying_users="bigint")

# Beside the served columns, a stored sale has its partition, where it came from, and the natural keys that had no match.
STORED_SALES = T.StructType(
    [*STAR["fact_sales"].fields, *_columns(month_key="int", origin="string", pending_user="string", pending_product="string").fields]
)
STORED_SPEND = T.StructType([*STAR["fact_ad_spend"].fields, *_columns(origin="string").fields])
LIVE = "live"

DIMENSIONS = ("dim_user", "dim_product", "dim_platform", "dim_date", "dim_influencer")
FACTS = ("fact_ad_spend", "fact_sales", "fact_marketing_performance")


def conform(df: DataFrame, table: str, *more: str) -> DataFrame:
    """Project ``df`` to the declared columns, order and types of a star table, and ``more`` columns as they are."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STAR[table].fields], *more)
