"""The queries once more, as SQL for an independent engine over the given tables.

The cleaning rules are spelled out here on their own terms; only the texts of
the messy sources are shared with the Spark side.  Rounded ratios are computed
in whole cents, so that ties round alike on both sides.
"""

from __future__ import annotations

from workload.messy import SOURCES

ORACLE: dict[str, str] = {}


def _messy_date(column: str) -> str:
    us = f"try_strptime(trim({column}), '%m/%d/%Y')"
    return (
        f"case when month({us}) <= 2 then cast({us} as date) "
        f"when regexp_full_match(trim({column}), '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') "
        f"then cast(try_strptime(trim({column}), '%d/%m/%Y') as date) end"
    )


def _spend_ctes(prefix: str, src: str, cost: str = "cost") -> dict[str, str]:
    return {
        f"{prefix}_src": SOURCES[src][0],
        f"{prefix}_clean": f"""
            select event_date, platform,
                   case when lower(trim(platform)) in ('fb', 'facebook', 'facebã¶k') then 'facebook'
                        when lower(trim(platform)) in ('g_ads', 'google_ads') then 'google_ads'
                        when lower(trim(platform)) = 'tiktok' then 'tiktok' end as name,
                   {_messy_date("event_date")} as day,
                   try_cast({cost} as decimal(20,6)) as amount
            from {prefix}_src""",
        f"{prefix}_daily": f"""
            select day, name, cast(sum(amount) as decimal(18,2)) as total_cost
            from {prefix}_clean where day is not null and name is not null group by day, name""",
        f"{prefix}_fact": f"""
            select d.date_key, p.platform_key, s.total_cost
            from {prefix}_daily s left join dim_date d on s.day = d.full_date
            left join dim_platform p on s.name = p.platform""",
    }


# Name -> body; a query takes what it needs, in this order.
CTES: dict[str, str] = {
    "sales_src": SOURCES["sales_dump"][0],
    "sales_clean": """
        select sale_id, user_id, product_name, amount, "timestamp",
               case when contains(amount, '€') then 'EUR' else 'USD' end as currency, num,
               case when num = -50 then cast(0 as decimal(12,2))
                    when contains(amount, '€') then try_cast(num * 1.08 as decimal(12,2))
                    else try_cast(num as decimal(12,2)) end as usd,
               sold, cast(strftime(sold, '%Y%m%d') as int) as date_key
        from (select *, try_cast(regexp_replace(amount, '[^0-9.-]', '', 'g') as double) as num,
                     try_cast("timestamp" as timestamp) as sold from sales_src)""",
    "leads_src": SOURCES["raw_web_leads"][0],
    "leads_clean": f"""
        select case when lower(trim(source)) in ('fb', 'fb_social', 'facebook_ads') then 'facebook'
                    when lower(trim(source)) in ('g_ads', 'google_ads', 'google_paid', 'google-ads') then 'google_ads'
                    when lower(trim(source)) = 'organic' then 'organic' else 'other' end as name,
               {_messy_date("signup_date")} as day
        from leads_src""",
    "visits": SOURCES["website_interactions"][0],
    "users_src": SOURCES["crm_users_export"][0],
    "products_src": SOURCES["product_codes"][0],
    "campaigns_src": SOURCES["influencer_campaigns"][0],
    **{k: v for k, v in _spend_ctes("spend", "daily_ad_spend").items() if k in ("spend_src", "spend_clean")},
    "dim_platform": """
        select cast(row_number() over (order by platform) as int) as platform_key, platform
        from (select name as platform from spend_clean where name is not null
              union select name from leads_clean)""",
    "bounds": """
        select min(day) as lo, max(day) as hi from (
            select cast(sold as date) as day from sales_clean
            union all select cast(try_cast(ts as timestamp) as date) from visits
            union all select day from spend_clean
            union all select day from leads_clean)""",
    "dim_date": """
        select full_date, cast(strftime(full_date, '%Y%m%d') as int) as date_key,
               cast(year(full_date) as int) as year, cast(month(full_date) as int) as month,
               monthname(full_date) as month_name, cast(day(full_date) as int) as day,
               cast(weekofyear(full_date) as int) as week_of_year, cast(quarter(full_date) as int) as quarter,
               cast(dayofweek(full_date) + 1 as int) as day_of_week,
               case when dayofweek(full_date) in (0, 6) then 1 else 0 end as is_weekend
        from (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as full_date from bounds)""",
    "dim_user": """
        select cast(row_number() over (order by user_id nulls first) as int) as user_key,
               user_id, full_name, email, phone
        from (select *, row_number() over (partition by user_id
                  order by full_name nulls last, email nulls last, phone nulls last) as pick
              from (select trim(user_id) as user_id, trim(full_name) as full_name, trim(email) as email,
                           regexp_replace(trim(phone), '[^0-9]', '', 'g') as phone from users_src))
        where pick = 1
        union all select 0, 'UNKNOWN', 'Unknown', null, null""",
    "dim_product": """
        select cast(row_number() over (order by product_code nulls first) as bigint) as product_key,
               product_code, product_name, retail_price
        from (select *, row_number() over (partition by product_code
                  order by product_name nulls last, retail_price nulls last) as pick
              from (select p_code as product_code, trim(p_name) as product_name,
                           try_cast(regexp_replace(retail_price, '[^0-9.]', '', 'g') as double) as retail_price
                    from products_src))
        where pick = 1
        union all select -1, 'N/A', 'Unknown Product', 0.0""",
    "dim_influencer": """
        select cast(row_number() over (order by inf_id nulls first) as bigint) as influencer_key,
               inf_id, handle, reach, rate, ref_code
        from (select *, row_number() over (partition by inf_id order by handle nulls last,
                  reach nulls last, rate nulls last, ref_code nulls last) as pick
              from (select inf_id, ref_code,
                           lower(trim(json_extract_string(doc, '$.handle'))) as handle,
                           case when json_type(doc, '$.reach') in ('UBIGINT', 'BIGINT')
                                then cast(json_extract(doc, '$.reach') as int) end as reach,
                           case when json_type(doc, '$.rate') in ('DOUBLE', 'UBIGINT', 'BIGINT')
                                then cast(json_extract(doc, '$.rate') as double) end as rate
                    from (select *, case when json_valid(metadata) then cast(metadata as json) end as doc
                          from campaigns_src)))
        where pick = 1""",
    "product_names": "select product_name, min(product_key) as product_key from dim_product group by product_name",
    "sales_conformed": """
        select s.sale_id, s.date_key, coalesce(u.user_key, 0) as user_key, p.product_key, s.usd as amount
        from sales_clean s
        left join (select user_id, min(user_key) as user_key from dim_user group by user_id) u
               on trim(s.user_id) = u.user_id
        left join product_names p on trim(s.product_name) = p.product_name""",
    "sales_fact": """
        select sale_id, date_key, user_key, coalesce(product_key, -1) as product_key, amount
        from sales_conformed where date_key is not null""",
    **{k: v for k, v in _spend_ctes("spend", "daily_ad_spend").items() if k in ("spend_daily", "spend_fact")},
    **_spend_ctes("event", "event_spend"),
    # Days and platforms that are new since the batch run join their dimensions.
    "live_platform": """
        select platform_key, platform from dim_platform
        union all
        select cast((select max(platform_key) from dim_platform) + row_number() over (order by name) as int), name
        from (select distinct name from event_daily
              where name is not null and name not in (select platform from dim_platform))""",
    "event_live": """
        select cast(strftime(day, '%Y%m%d') as int) as date_key, platform_key, total_cost
        from event_daily join live_platform on name = platform""",
    **_spend_ctes("fixed", "daily_ad_spend", "'2.5'"),
    "purchases": """
        select cast(strftime(ts, '%Y%m%d') as int) as date_key, cast(user_id as int) as user_key,
               cast(value as decimal(12,2)) as amount
        from events where event_type = 'purchase'""",
    "impressions": """
        select cast(strftime(ts, '%Y%m%d') as int) as date_key, cast(value as decimal(18,2)) as total_cost
        from events where event_type in ('click', 'view')""",
    "order_sales": """
        select cast(o_orderkey as varchar) as sale_id, cast(strftime(o_orderdate, '%Y%m%d') as int) as date_key,
               cast(o_custkey as int) as user_key, o_custkey as product_key,
               cast(o_totalprice as decimal(12,2)) as amount
        from orders""",
    "order_spend": "select date_key, amount as total_cost from order_sales",
    "shipment_sales": """
        select cast(strftime(l_shipdate, '%Y%m%d') as int) as date_key, l_suppkey as user_key,
               cast(l_extendedprice as decimal(12,2)) as amount
        from lineitem""",
    "updates": """
        select cast(o_orderkey * 2 as varchar) as sale_id, cast(strftime(o_orderdate, '%Y%m%d') as int) as date_key,
               cast(o_custkey as int) as user_key, o_custkey as product_key, cast(1.25 as decimal(12,2)) as amount
        from orders""",
    "dropped_again": """
        select concat('S', lpad(cast(cast(substr(sale_id, 2, 10) as bigint) * 2 as varchar), 10, '0')) as sale_id,
               date_key, user_key, product_key, amount
        from sales_fact""",
    "streamed_sales": """
        select * from sales_fact union all
        select * from dropped_again where sale_id not in (select sale_id from sales_fact)""",
}


def _sql(body: str, *needed: str, **extra: str) -> str:
    """A WITH query that takes the needed CTEs and whatever those refer to."""
    pool = {**CTES, **extra}
    wanted: set[str] = set()

    def take(name: str) -> None:
        if name in wanted:
            return
        wanted.add(name)
        text = pool[name]
        for other in pool:
            if other != name and other in _words(text):
                take(other)

    for name in needed:
        take(name)
    return "with " + ",\n".join(f"{n} as ({pool[n]})" for n in pool if n in wanted) + "\n" + body


def _words(text: str) -> set[str]:
    return set("".join(c if c.isalnum() or c == "_" else " " for c in text).split())


def _performance(sales: str, spend: str) -> dict[str, str]:
    """Daily metrics of two relations, as CTE ``perf`` with decimals and exact half-up ratios."""
    return {
        "perf": f"""
            select coalesce(a.date_key, s.date_key) as date_key, total_ad_spend, total_revenue, paying_users, distinct_payers,
                   case when total_ad_spend > 0 then cast((2 * cast(total_revenue * 100 as hugeint) * 10000
                        + cast(total_ad_spend * 100 as hugeint)) // (2 * cast(total_ad_spend * 100 as hugeint)) as double) / 10000.0 end as roas,
                   case when paying_users > 0 then cast((2 * cast(total_ad_spend * 100 as hugeint) + paying_users)
                        // (2 * paying_users) as double) / 100.0 end as cac,
                   case when distinct_payers > 0 then cast((2 * cast(total_ad_spend * 100 as hugeint) + distinct_payers)
                        // (2 * distinct_payers) as double) / 100.0 end as distinct_cac
            from (select date_key, sum(total_cost) as total_ad_spend from {spend} group by date_key) a
            full join (select date_key, sum(amount) as total_revenue,
                              count(case when user_key <> 0 then 1 end) as paying_users,
                              count(distinct case when user_key <> 0 then user_key end) as distinct_payers
                       from {sales} group by date_key) s
            on a.date_key = s.date_key"""
    }


PERFORMANCE_COLUMNS = """
    cast(date_key as bigint) as perf_key, date_key, cast(total_ad_spend as double) as total_ad_spend,
    cast(total_revenue as double) as total_revenue, cast(paying_users as bigint) as paying_users, roas, cac"""
SALES_COLUMNS = "sale_id, date_key, user_key, product_key, cast(amount as double) as amount"
SPEND_COLUMNS = """
    cast(date_key as bigint) * 100000 + platform_key as ad_spend_key, date_key, platform_key,
    cast(total_cost as double) as total_cost"""
DAY = "cast(strptime(cast(date_key as varchar), '%Y%m%d') as date)"


def _perf_sql(sales: str, spend: str, body: str) -> str:
    return _sql(body, "perf", **_performance(sales, spend))


EVENTS = ("purchases", "impressions")

ORACLE["marketing_performance"] = _perf_sql(*EVENTS, f"select {PERFORMANCE_COLUMNS} from perf")
ORACLE["performance_outer_days"] = _perf_sql(
    "shipment_sales", "order_spend", f"select {PERFORMANCE_COLUMNS} from perf"
)
ORACLE["paying_users_distinct"] = _perf_sql(
    *EVENTS,
    f"select {PERFORMANCE_COLUMNS}, distinct_payers as distinct_paying_users, distinct_cac from perf",
)
ORACLE["platform_canonical"] = _sql(
    "select name as platform, count(*) as spend_rows from spend_clean group by name", "spend_clean"
)
ORACLE["lead_source_canonical"] = _sql(
    "select name as platform, count(*) as leads from leads_clean group by name", "leads_clean"
)
ORACLE["amount_usd"] = _sql(
    "select sale_id, currency, num as amount_numeric, cast(usd as double) as amount_usd from sales_clean",
    "sales_clean",
)
ORACLE["sale_timestamps"] = _sql(
    "select sale_id, strftime(sold, '%Y-%m-%d %H:%M:%S') as sold_at, date_key from sales_clean", "sales_clean"
)
ORACLE["ambiguous_date"] = _sql(
    """select event_date, day as spend_date, count(*) as spend_rows
       from (select event_date, day from event_clean union all select event_date, day from spend_clean)
       group by event_date, day""",
    "event_clean",
    "spend_clean",
)
ORACLE["json_flatten"] = "select event_id, cast(json_extract(props, '$.k') as int) as k from events"
for name in ("dim_platform", "dim_product", "dim_user", "dim_influencer"):
    ORACLE[name] = _sql(f"select * from {name}", name)
ORACLE["calendar"] = _sql("select * from dim_date", "dim_date")
ORACLE["stable_keys"] = """
with first_run as (
    select member, row_number() over (order by member) as member_key
    from (select distinct cast(user_id as varchar) as member from events)),
later as (
    select member, (select max(member_key) from first_run) + row_number() over (order by member) as member_key
    from (select cast(c_custkey as varchar) as member from customer)
    where member not in (select member from first_run))
select member, member_key from first_run union all select member, member_key from later"""


def _counts(*tables: tuple[str, str], column: str = "row_count") -> str:
    return " union all ".join(
        f"select '{label}' as table_name, count(*) as {column} from {relation}" for label, relation in tables
    )


STAR_DIMS = ("dim_date", "dim_platform", "dim_product", "dim_user")
ORACLE["promote_dims"] = _sql(_counts(*[(n, n) for n in STAR_DIMS]), *STAR_DIMS)
ORACLE["fact_ad_spend"] = _sql(
    f"select {SPEND_COLUMNS} from spend_fact where date_key is not null and platform_key is not null",
    "spend_fact",
)
ORACLE["fact_sales"] = _sql(f"select {SALES_COLUMNS} from sales_fact", "sales_fact")
ORACLE["fact_sales_shuffled"] = ORACLE["fact_sales"]
ORACLE["fact_sales_no_fanout"] = _sql(
    """select date_key, count(*) as source_rows, cast(sum(usd) as double) as source_amount,
              count(*) as fact_rows, cast(sum(usd) as double) as fact_amount
       from sales_clean group by date_key""",
    "sales_clean",
)
ORACLE["fk_orphans"] = """
select l_partkey as user_key, count(*) as fact_rows from lineitem
where l_partkey not in (select c_custkey from customer) group by l_partkey"""
ORACLE["fk_orphan_sample"] = ORACLE["fk_orphans"] + " order by fact_rows desc, user_key limit 10"
ORACLE["fk_orphan_rows"] = """
select l_orderkey, l_linenumber, l_partkey as user_key from lineitem
where l_partkey not in (select c_custkey from customer)"""


def _fk(fact: str, column: str, dim: str) -> str:
    return f"""
        select '{column}' as fk, count(*) as fact_rows,
               count(case when f.{column} is null then 1 end) as null_rows,
               count(case when f.{column} is not null and d.k is null then 1 end) as unmatched_rows,
               count(case when d.k is null then 1 end) as orphan_rows,
               count(distinct case when d.k is null then f.{column} end) as unmatched_keys
        from {fact} f left join (select distinct {column} as k from {dim}) d on f.{column} = d.k"""


ORACLE["fk_report"] = _sql(
    " union all ".join(
        _fk("sales_conformed", c, d)
        for c, d in (("date_key", "dim_date"), ("user_key", "dim_user"), ("product_key", "dim_product"))
    ),
    "sales_conformed",
    "dim_date",
)
ORACLE["fk_report_spend"] = _sql(
    _fk("spend_fact", "date_key", "dim_date") + " union all " + _fk("spend_fact", "platform_key", "dim_platform"),
    "spend_fact",
)


def _checks(table: str, relation: str, **checks: str) -> str:
    return " union all ".join(
        f"select '{table}' as table_name, '{check}' as check_name, cast({value} as double) as value from {relation}"
        for check, value in checks.items()
    )


def _where(condition: str) -> str:
    return f"count(case when {condition} then 1 end)"


ORACLE["quality_report"] = _sql(
    " union all ".join(
        [
            _checks(
                "sales_clean",
                "sales_clean",
                rows="count(*)",
                bad_timestamp=_where("date_key is null"),
                bad_amount=_where("usd is null"),
                null_user=_where("user_id is null"),
                total_amount="sum(usd)",
            ),
            _checks(
                "fact_sales",
                "sales_conformed",
                rows="count(*)",
                null_date_key=_where("date_key is null"),
                null_user_key=_where("user_key is null"),
                null_product_key=_where("product_key is null"),
                unknown_user=_where("user_key = 0"),
                total_amount="sum(amount)",
            ),
            _checks(
                "spend_clean",
                "spend_clean",
                rows="count(*)",
                unknown_platform=_where("name is null"),
                bad_date=_where("day is null"),
                bad_cost=_where("amount is null"),
                total_cost="sum(amount)",
            ),
            _checks(
                "fact_ad_spend",
                "spend_fact",
                rows="count(*)",
                null_date_key=_where("date_key is null"),
                null_platform_key=_where("platform_key is null"),
                total_cost="sum(total_cost)",
            ),
        ]
    ),
    "sales_conformed",
    "spend_fact",
)
ORACLE["rejects_by_reason"] = _sql(
    """select table_name, reason, count(*) as rejected from (
           select 'sales_dump' as table_name, 'no_sale_id' as reason from sales_clean where sale_id is null
           union all select 'sales_dump', 'bad_timestamp' from sales_clean where date_key is null
           union all select 'sales_dump', 'bad_amount' from sales_clean where usd is null
           union all select 'daily_ad_spend', 'unknown_platform' from spend_clean where name is null
           union all select 'daily_ad_spend', 'bad_date' from spend_clean where day is null
           union all select 'daily_ad_spend', 'bad_cost' from spend_clean where amount is null)
       group by table_name, reason""",
    "sales_clean",
    "spend_clean",
)
ORACLE["unknown_users"] = _sql(
    "select trim(user_id) as user_id from sales_src except select user_id from dim_user", "sales_src", "dim_user"
)
GIVEN = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
ORACLE["table_counts"] = _counts(*[(n, n) for n in GIVEN.split()])
ORACLE["report_daily_performance"] = _perf_sql(
    *EVENTS,
    f"""select date_key, {DAY} as date, cast(coalesce(total_ad_spend, 0) as double) as total_ad_spend,
               cast(coalesce(total_revenue, 0) as double) as total_revenue,
               cast(coalesce(paying_users, 0) as bigint) as paying_users, roas, cac
        from perf where date_key is not null order by date_key""",
)
PLATFORM_ROAS = """
    platform_roas as (
        select platform, cast(total_spend as double) as total_spend, cast(revenue as double) as total_revenue,
               case when total_spend > 0 then cast((2 * cast(revenue * 100 as hugeint) * 10000
                    + cast(total_spend * 100 as hugeint)) // (2 * cast(total_spend * 100 as hugeint)) as double) / 10000.0
                    else 0 end as roas
        from (select platform, sum(total_cost) as total_spend from spend_fact
              join dim_platform using (platform_key) where date_key is not null group by platform)
        cross join (select coalesce(sum(amount), 0) as revenue from order_sales))"""
PLATFORM_ROAS_BODY = PLATFORM_ROAS.split("as (", 1)[1].rsplit(")", 1)[0]
ORACLE["report_roas_by_platform"] = _sql(
    "select * from platform_roas order by roas desc", "platform_roas", platform_roas=PLATFORM_ROAS_BODY
)
ORACLE["report_platform_breakdown"] = _sql(
    "select platform, total_spend, roas, case when roas >= 1 then 1 else 0 end as profitable from platform_roas",
    "platform_roas",
    platform_roas=PLATFORM_ROAS_BODY,
)
ORACLE["report_cac_over_time"] = _perf_sql(
    *EVENTS,
    f"""select {DAY} as date, cac, cast(total_ad_spend as double) as total_ad_spend,
               cast(coalesce(paying_users, 0) as bigint) as paying_users
        from perf where cac is not null order by date_key""",
)
ORACLE["report_cac_summary"] = _perf_sql(
    *EVENTS,
    """select min(cac) as min_cac, round(avg(cac), 6) as avg_cac, max(cac) as max_cac
       from perf where cac is not null""",
)
ORACLE["report_sales_feed"] = _sql(
    f"""select sale_id, {DAY} as date, coalesce(c_name, 'Unknown') as customer,
               coalesce(p_name, 'Unknown') as product, cast(coalesce(amount, 0) as double) as amount
        from order_sales left join customer on user_key = c_custkey left join part on product_key = p_partkey
        order by date_key desc, sale_id desc limit 50""",
    "order_sales",
)
ORACLE["report_sales_feed_stored"] = ORACLE["report_sales_feed"]
ORACLE["report_daily_sales"] = _sql(
    f"""select {DAY} as date, cast(sum(amount) as double) as daily_revenue, count(sale_id) as transactions
        from order_sales group by date_key order by date_key""",
    "order_sales",
)
ORACLE["report_kpis"] = _perf_sql(
    *EVENTS,
    """select cast(coalesce(sum(total_revenue), 0) as double) as total_revenue,
              cast(coalesce(sum(total_ad_spend), 0) as double) as total_spend,
              round(coalesce(avg(roas), 0), 6) as avg_roas, round(coalesce(avg(cac), 0), 6) as avg_cac,
              cast(coalesce(sum(paying_users), 0) as bigint) as total_customers
       from perf""",
)
ORACLE["report_overall_roas"] = _perf_sql(
    *EVENTS,
    """select total_revenue, total_spend, round(ratio, 6) as overall_roas,
              case when ratio > 1 then 1 else 0 end as profitable
       from (select *, case when total_spend > 0 then total_revenue / total_spend else 0 end as ratio
             from (select cast(coalesce(sum(total_revenue), 0) as double) as total_revenue,
                          cast(coalesce(sum(total_ad_spend), 0) as double) as total_spend from perf))""",
)
ORACLE["report_roas_trend"] = _perf_sql(
    *EVENTS,
    f"""select {DAY} as date, roas, case when roas >= 1 then 1 else 0 end as profitable
        from perf where roas is not null order by date_key""",
)
ORACLE["total_sales"] = "select count(*) as total_sales from orders"
ORACLE["raw_roundtrip"] = SOURCES["sales_dump"][0]
ORACLE["raw_roundtrip_json"] = SOURCES["influencer_campaigns"][0]
ORACLE["export_roundtrip"] = _sql("select * from dim_user", "dim_user")
EXPORTED = ("dim_user", "dim_product", "dim_influencer")
ORACLE["export_verified"] = _sql(
    "select table_name, row_count, row_count as loaded_count, true as matches from ("
    + _counts(*[(n, n) for n in EXPORTED])
    + ")",
    *EXPORTED,
)
ORACLE["upsert_sales_insert_only"] = _sql(
    f"""select {SALES_COLUMNS} from order_sales union all
        select {SALES_COLUMNS} from updates where sale_id not in (select sale_id from order_sales)""",
    "order_sales",
    "updates",
)
ORACLE["upsert_merge"] = _sql(
    f"""select {SALES_COLUMNS} from updates union all
        select {SALES_COLUMNS} from order_sales where sale_id not in (select sale_id from updates)""",
    "order_sales",
    "updates",
)
ORACLE["last_update_wins"] = """
select l_orderkey, ship_key, l_linenumber, l_extendedprice from (
    select *, row_number() over (partition by l_orderkey
                                 order by ship_key desc, l_linenumber desc, l_extendedprice desc) as pick
    from (select l_orderkey, cast(strftime(l_shipdate, '%Y%m%d') as int) as ship_key, l_linenumber, l_extendedprice
          from lineitem))
where pick = 1"""
ORACLE["refresh_touched_days"] = ORACLE["marketing_performance"]
ORACLE["stream_sales"] = _sql(f"select {SALES_COLUMNS} from streamed_sales", "streamed_sales")
ORACLE["stream_sales_performance"] = _sql(
    f"select {PERFORMANCE_COLUMNS} from perf where date_key in (select date_key from streamed_sales)",
    "perf",
    "streamed_sales",
    complete_spend="select * from spend_fact where date_key is not null and platform_key is not null",
    **_performance("streamed_sales", "complete_spend"),
)
ORACLE["stream_ad_spend"] = _sql(
    f"""select {SPEND_COLUMNS} from (
            select * from fixed_fact where date_key is not null and platform_key is not null
            union all
            select * from event_live e
            where not exists (select 1 from fixed_fact f
                              where f.date_key = e.date_key and f.platform_key = e.platform_key))""",
    "fixed_fact",
    "event_live",
)
ORACLE["end_to_end_performance"] = _sql(
    f"select {PERFORMANCE_COLUMNS} from perf",
    "perf",
    complete_spend="select * from spend_fact where date_key is not null and platform_key is not null",
    **_performance("sales_fact", "complete_spend"),
)
ORACLE["end_to_end_counts"] = _sql(
    _counts(
        *[(n, n) for n in ("dim_user", "dim_product", "dim_platform", "dim_date", "dim_influencer")],
        ("fact_ad_spend", "complete_spend"),
        ("fact_sales", "sales_fact"),
        ("fact_marketing_performance", "perf"),
    ),
    "perf",
    "dim_influencer",
    "complete_spend",
    complete_spend="select * from spend_fact where date_key is not null and platform_key is not null",
    **_performance("sales_fact", "complete_spend"),
)
ORACLE["serving_sql"] = _sql(
    """select year, month, side, count(*) as entries, cast(sum(value) as double) as total
       from (select year, month, 'sales' as side, cast(amount as decimal(18,2)) as value
             from order_sales join dim_date using (date_key)
             union all
             select year, month, platform, total_cost
             from spend_fact join dim_date using (date_key) join dim_platform using (platform_key))
       group by year, month, side""",
    "order_sales",
    "spend_fact",
)
ORACLE["raw_by_name"] = SOURCES["sales_dump"][0]
ORACLE["stream_by_name"] = ORACLE["fact_sales"]
ORACLE["replayed_batches"] = ORACLE["fact_sales"]
ORACLE["metrics_by_delta"] = ORACLE["end_to_end_performance"]
ORACLE["rerun_after_drop"] = _sql(
    f"select {PERFORMANCE_COLUMNS} from perf",
    "perf",
    "streamed_sales",
    complete_spend="select * from spend_fact where date_key is not null and platform_key is not null",
    **_performance("streamed_sales", "complete_spend"),
)
ORACLE["late_members"] = _sql(
    """select sale_id, date_key, user_id, cast(amount as double) as amount
       from sales_fact join dim_user using (user_key)""",
    "sales_fact",
    "dim_user",
)
ORACLE["influencer_rejects"] = _sql(
    """select inf_id, ref_code, metadata, 'no_inf_id' as reason from campaigns_src where inf_id is null
       union all
       select inf_id, ref_code, metadata, 'bad_metadata' from campaigns_src where metadata is not null and not json_valid(metadata)""",
    "campaigns_src",
)
