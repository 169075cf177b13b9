"""Messy marketing sources derived from the given tables.

Each source is one SQL text that Spark and the oracle engine both run, over
whole tables.  Keys choose a spelling per row; no row is left out.  Money is
spelled from whole cents, so both engines write the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roastery.schemas import SOURCES as SCHEMAS
from roastery.storage import scratch_path, table_exists


def _cents(value: str) -> str:
    return f"cast(round({value} * 100) as bigint)"


def _money_text(cents: str, thousands: bool = False) -> str:
    whole = f"cast(floor({cents} / 100) as bigint)"
    rest = f"lpad(cast({cents} % 100 as string), 2, '0')"
    if not thousands:
        return f"concat(cast({whole} as string), '.', {rest})"
    upper = f"cast(floor({whole} / 1000) as bigint)"
    lower = f"{whole} % 1000"
    return (
        f"case when {whole} >= 1000 then concat(cast({upper} as string), ',', "
        f"lpad(cast({lower} as string), 3, '0'), '.', {rest}) "
        f"else concat(cast({whole} as string), '.', {rest}) end"
    )


def _two(number: str) -> str:
    return f"lpad(cast({number} as string), 2, '0')"


def _iso(ts: str) -> str:
    return f"concat(cast(year({ts}) as string), '-', {_two(f'month({ts})')}, '-', {_two(f'day({ts})')})"


def _dmy(ts: str) -> str:
    return f"concat({_two(f'day({ts})')}, '/', {_two(f'month({ts})')}, '/', cast(year({ts}) as string))"


def _mdy(ts: str, padded: bool = True) -> str:
    month = _two(f"month({ts})") if padded else f"cast(month({ts}) as string)"
    day = _two(f"day({ts})") if padded else f"cast(day({ts}) as string)"
    return f"concat({month}, '/', {day}, '/', cast(year({ts}) as string))"


SALES_DUMP = f"""
select concat('S', lpad(cast(o_orderkey as string), 10, '0')) as sale_id,
       case when o_orderkey % 11 = 0 then null
            when o_orderkey % 13 = 0 then 'UNKNOWN'
            when o_orderkey % 17 = 0 then concat('ghost', cast(o_custkey as string))
            when o_orderkey % 3 = 0 then concat('  U', cast(o_custkey as string), ' ')
            else concat('U', cast(o_custkey as string)) end as user_id,
       case when o_orderkey % 19 = 0 then 'Discontinued'
            when p_name is null then null
            when o_orderkey % 4 = 0 then concat('  ', p_name)
            else p_name end as product_name,
       case when o_orderkey % 23 = 0 then null
            when o_orderkey % 29 = 0 then '1-2'
            when o_orderkey % 31 = 0 then '-50'
            when o_orderkey % 37 = 0 then '€-50'
            when o_orderkey % 4 = 0 then concat('€', {_money_text(_cents("o_totalprice"), True)})
            when o_orderkey % 4 = 1 then concat('$ ', {_money_text(_cents("o_totalprice"), True)})
            else {_money_text(_cents("o_totalprice"))} end as amount,
       case when o_orderkey % 41 = 0 then 'not a time'
            when o_orderkey % 43 = 0 then null
            else concat({_iso("o_orderdate")}, ' ', lpad(cast(o_orderkey % 24 as string), 2, '0'), ':30:00')
            end as timestamp
from orders left join part on p_partkey = o_custkey
"""

# Spend from shipments, so that spend days and sale days overlap.
SHIPMENT_SPEND = f"""
select case when l_orderkey % 47 = 0 then {_iso("l_shipdate")}
            when l_orderkey % 5 = 0 then concat(' ', {_mdy("l_shipdate")})
            when l_orderkey % 5 = 1 then {_mdy("l_shipdate", False)}
            else {_dmy("l_shipdate")} end as event_date,
       case l_orderkey % 9 when 0 then 'fb' when 1 then ' FB ' when 2 then 'Facebook'
            when 3 then 'facebã¶k' when 4 then 'g_ads' when 5 then 'Google_Ads'
            when 6 then 'TikTok' when 7 then 'myspace' else null end as platform,
       case when l_orderkey % 53 = 0 then 'n/a'
            else {_money_text(_cents("l_extendedprice"))} end as cost
from lineitem
"""

EVENT_SPEND = f"""
select case when event_id % 47 = 0 then {_iso("ts")}
            when event_id % 3 = 0 then {_mdy("ts")}
            when event_id % 3 = 1 then {_mdy("ts", False)}
            else concat(' ', {_dmy("ts")}) end as event_date,
       case event_id % 9 when 0 then 'fb' when 1 then ' FB ' when 2 then 'Facebook'
            when 3 then 'facebã¶k' when 4 then 'g_ads' when 5 then 'Google_Ads'
            when 6 then 'TikTok' when 7 then 'myspace' else null end as platform,
       case when event_id % 53 = 0 then 'n/a' else {_money_text(_cents("value"))} end as cost
from events
"""

WEB_LEADS = f"""
select case event_id % 10 when 0 then 'fb' when 1 then 'FB_Social' when 2 then 'facebook_ads'
            when 3 then 'g_ads ' when 4 then 'google_ads' when 5 then 'google_paid'
            when 6 then 'google-ads' when 7 then 'Organic' when 8 then 'newsletter'
            else null end as source,
       {_dmy("ts")} as signup_date
from events
"""

INTERACTIONS = f"""
select concat({_iso("ts")}, ' ', {_two("hour(ts)")}, ':', {_two("minute(ts)")}, ':00') as ts from events
"""

CRM_USERS = """
select concat(' U', cast(c_custkey as string)) as user_id,
       concat('  ', c_name, ' ') as full_name,
       concat('u', cast(c_custkey as string), '@example.com ') as email,
       concat('+1 (555) ', lpad(cast(c_custkey as string), 8, '0')) as phone
from customer
union all
select concat('U', cast(c_custkey as string), '  '), c_name,
       case when c_custkey % 2 = 0 then null else concat('a', cast(c_custkey as string), '@example.com') end,
       concat('0', lpad(cast(c_nationkey as string), 4, '0'), '-', cast(c_custkey as string))
from customer
"""

PRODUCT_CODES = f"""
select concat('P', lpad(cast(p_partkey as string), 9, '0')) as p_code,
       concat(' ', p_name, '  ') as p_name,
       concat('$', {_money_text(_cents("p_retailprice"), True)}) as retail_price
from part
union all
select concat('P', lpad(cast(p_partkey as string), 9, '0')), p_name,
       case when p_partkey % 3 = 0 then null
            else concat('-', {_money_text("(" + _cents("p_retailprice") + " + 100)")}) end
from part
"""

CAMPAIGNS = """
select concat('I', lpad(cast(c_custkey as string), 9, '0')) as inf_id,
       concat('REF', cast(c_nationkey as string)) as ref_code,
       case c_custkey % 6
            when 0 then concat('{"handle":" @', c_name, '","reach":', cast(c_custkey as string), '}')
            when 1 then concat('{"handle":"@', c_name, '","reach":', cast(c_custkey as string), ',"rate":1.5}')
            when 2 then concat('{"handle":"x","reach":"', cast(c_custkey as string), '","rate":2}')
            when 3 then 'not json'
            when 4 then concat('{"reach":', cast(c_custkey as string), ',"rate":0.25}')
            else null end as metadata
from customer
union all
select concat('I', lpad(cast(c_custkey as string), 9, '0')), concat('ZREF', cast(c_nationkey as string)),
       '{"handle":"zz","reach":1}'
from customer
"""

SOURCES = {
    "product_codes": (PRODUCT_CODES, ("part",)),
    "daily_ad_spend": (SHIPMENT_SPEND, ("lineitem",)),
    "event_spend": (EVENT_SPEND, ("events",)),
    "raw_web_leads": (WEB_LEADS, ("events",)),
    "sales_dump": (SALES_DUMP, ("orders", "part")),
    "website_interactions": (INTERACTIONS, ("events",)),
    "crm_users_export": (CRM_USERS, ("customer",)),
    "influencer_campaigns": (CAMPAIGNS, ("customer",)),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


COLUMNS = {name: schema.fieldNames() for name, schema in SCHEMAS.items()}
COLUMNS["event_spend"] = COLUMNS["daily_ad_spend"]
_stored: dict[tuple[str, str, str], str] = {}


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One messy source, as a raw table: derived once per session, then read like any ingested one."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    path = _stored.get(key)
    if path is None or not table_exists(spark, path):
        text, tables = SOURCES[name]
        for given in tables:
            table(spark, sf_dir, given).createOrReplaceTempView(given)
        path = scratch_path(spark, f"raw-{name}")
        derived, cores = spark.sql(text), spark.sparkContext.defaultParallelism
        # Small given files come as one split each; spread the text work over the cores.  Large ones have splits enough.
        if table(spark, sf_dir, tables[0]).rdd.getNumPartitions() < cores:
            derived = derived.repartition(cores)
        derived.write.parquet(path)
        _stored[key] = path
    return spark.read.schema(", ".join(f"`{c}` string" for c in COLUMNS[name])).parquet(path)
