"""Every operator as a query over the given tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roastery import schemas
from roastery.functions import day_key, parse_ambiguous_date, parse_timestamp
from roastery.operators import dims, facts, metrics, quality, reports
from roastery.operators.keys import assign_keys
from roastery.operators.upsert import last_by_key, merge_snapshot, upsert
from roastery.plans.lakehouse import (
    Layout,
    read_latest_sales,
    read_measures,
    read_sales,
    read_served,
    refresh_days,
    register_views,
    run_pipeline,
    served_tables,
    with_sales_partition,
)
from roastery.rules import DEFAULT_RULES
from roastery.sources.export import export_tables, read_exported, verify_export
from roastery.sources.raw import PROVENANCE, ingest_raw
from roastery.storage import read_table, scratch_path, side_by_side, write_snapshot, write_table
from roastery.streaming.live import process_sales, watch
from workload.drops import CSV_OPTIONS, drop_csv, write_csv_sources
from workload.messy import source, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, because engines disagree on decimal widths."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --- facts straight from the given tables -------------------------------------------------


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return events.select(
        F.col("event_id").cast("string").alias("sale_id"),
        day_key(F.to_date("ts")).alias("date_key"),
        F.col("user_id").cast("int").alias("user_key"),
        F.col("value").cast("decimal(12,2)").alias("amount"),
    )


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view"))
    return events.select(
        day_key(F.to_date("ts")).alias("date_key"), F.col("value").cast("decimal(18,2)").alias("total_cost")
    )


def event_performance(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return metrics.marketing_performance(purchases(spark, sf_dir), impressions(spark, sf_dir), **options)


def order_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("sale_id"),
        day_key(F.to_date("o_orderdate")).alias("date_key"),
        F.col("o_custkey").cast("int").alias("user_key"),
        F.col("o_custkey").alias("product_key"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
    )


def shipment_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        day_key(F.to_date("l_shipdate")).alias("date_key"),
        F.col("l_suppkey").alias("user_key"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
    )


# --- star tables from the messy sources ---------------------------------------------------


def messy_dim(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    def messy(source_name: str) -> DataFrame:
        return source(spark, sf_dir, source_name)

    if name == "dim_date":
        sources = ("sales_dump", "website_interactions", "daily_ad_spend", "raw_web_leads")
        return dims.dim_date(*dims.calendar_dates(*[messy(s) for s in sources]))
    if name == "dim_platform":
        return dims.dim_platform(messy("daily_ad_spend"), messy("raw_web_leads"))
    if name == "dim_user":
        return dims.dim_user(messy("crm_users_export"))
    return dims.dim_product(messy("product_codes"))


def stored_dims(spark: SparkSession, sf_dir: str, *names: str, dst: str | None = None) -> dict[str, DataFrame]:
    """Dimensions built from the messy sources and written, as facts would find them."""
    folder = dst or scratch_path(spark, "dims")
    built = {name: messy_dim(spark, sf_dir, name) for name in names}
    side_by_side(spark, {n: partial(write_table, df, f"{folder}/{n}") for n, df in built.items()})
    return {n: read_table(spark, f"{folder}/{n}", schemas.STAR[n]) for n in names}


def messy_spend(spark: SparkSession, sf_dir: str, star: dict[str, DataFrame]) -> DataFrame:
    spend = source(spark, sf_dir, "daily_ad_spend")
    return facts.fact_ad_spend(spend, star["dim_date"], star["dim_platform"])


def messy_sales(spark: SparkSession, sf_dir: str, star: dict[str, DataFrame], **sizes: bool) -> DataFrame:
    sales = source(spark, sf_dir, "sales_dump")
    return facts.fact_sales(sales, star["dim_user"], star["dim_product"], **sizes)


# --- metrics ------------------------------------------------------------------------------


@query
def marketing_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(event_performance(spark, sf_dir))


@query
def performance_outer_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    spend = order_sales(spark, sf_dir).select("date_key", F.col("amount").alias("total_cost"))
    return portable(metrics.marketing_performance(shipment_sales(spark, sf_dir), spend))


@query
def paying_users_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(event_performance(spark, sf_dir, distinct_users=True))


# --- cleaning -----------------------------------------------------------------------------


@query
def platform_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    spend = source(spark, sf_dir, "daily_ad_spend")
    return dims.ad_platforms(spend).groupBy("platform").agg(F.count(F.lit(1)).alias("spend_rows"))


@query
def lead_source_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    leads = source(spark, sf_dir, "raw_web_leads")
    return dims.lead_sources(leads).groupBy("platform").agg(F.count(F.lit(1)).alias("leads"))


@query
def amount_usd(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = facts.clean_sales(source(spark, sf_dir, "sales_dump"))
    return portable(cleaned.select("sale_id", "currency", "amount_numeric", "amount_usd"))


@query
def sale_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = source(spark, sf_dir, "sales_dump")
    parsed = parse_timestamp(F.col("timestamp"))
    return sales.select(
        "sale_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("sold_at"), day_key(F.to_date(parsed)).alias("date_key")
    )


@query
def ambiguous_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    spend = source(spark, sf_dir, "event_spend").unionByName(source(spark, sf_dir, "daily_ad_spend"))
    parsed = spend.select("event_date", parse_ambiguous_date(F.col("event_date")).alias("spend_date"))
    return parsed.groupBy("event_date", "spend_date").agg(F.count(F.lit(1)).alias("spend_rows"))


@query
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k int").alias("props")
    )
    return parsed.select("event_id", F.col("props.k").alias("k"))


# --- dimensions ---------------------------------------------------------------------------


@query
def dim_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_platform(source(spark, sf_dir, "daily_ad_spend"), source(spark, sf_dir, "raw_web_leads"))


@query
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messy_dim(spark, sf_dir, "dim_date")


@query
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_product(source(spark, sf_dir, "product_codes"))


@query
def dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_user(source(spark, sf_dir, "crm_users_export"))


@query
def dim_influencer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_influencer(source(spark, sf_dir, "influencer_campaigns"))


@query
def stable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buyers are numbered first; then all customers, who include them, in a second run."""
    buyers = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("member")).distinct()
    first = assign_keys(buyers, "member", "member_key", "bigint")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("member"))
    return assign_keys(customers, "member", "member_key", "bigint", known=first)


@query
def promote_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, dst = scratch_path(spark, "promote-src"), scratch_path(spark, "promote-dst")
    names = ["dim_date", "dim_platform", "dim_product", "dim_user"]
    stored_dims(spark, sf_dir, *names, dst=src)
    dims.promote_dims(spark, names, src, dst)
    return quality.table_counts({n: spark.read.parquet(f"{dst}/{n}") for n in names})


# --- facts --------------------------------------------------------------------------------


@query
def fact_ad_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = stored_dims(spark, sf_dir, "dim_date", "dim_platform")
    spend = messy_spend(spark, sf_dir, star)
    final, _report = facts.finalize_ad_spend(spend, star["dim_date"], star["dim_platform"])
    return portable(final)


@query
def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = stored_dims(spark, sf_dir, "dim_user", "dim_product")
    return portable(facts.with_product_fallback(messy_sales(spark, sf_dir, star)))


@query
def fact_sales_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fact through the join for dimensions too large to broadcast."""
    star = stored_dims(spark, sf_dir, "dim_user", "dim_product")
    sales = messy_sales(spark, sf_dir, star, small_users=False, small_products=False)
    return portable(facts.with_product_fallback(sales))


@query
def fact_sales_no_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and control total per day before and after the lookup by ambiguous product names."""
    cleaned = facts.clean_sales(source(spark, sf_dir, "sales_dump"))
    before = cleaned.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("source_rows"), F.sum("amount_usd").alias("source_amount")
    )
    star = stored_dims(spark, sf_dir, "dim_user", "dim_product")
    after = messy_sales(spark, sf_dir, star).groupBy("date_key").agg(
        F.count(F.lit(1)).alias("fact_rows"), F.sum("amount").alias("fact_amount")
    )
    joined = before.join(
        after.withColumnRenamed("date_key", "fact_day"), F.col("date_key").eqNullSafe(F.col("fact_day")), "left"
    )
    return portable(joined.drop("fact_day"))


# --- quality ------------------------------------------------------------------------------


@query
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part keys read as customer keys, against the customers: a real mismatch of domains."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("user_key"))
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_key"))
    return quality.orphan_keys(lines, users, "user_key", "user_key")


@query
def fk_orphan_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("user_key"))
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_key"))
    return quality.orphan_sample(lines, users, "user_key", "user_key")


@query
def fk_orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("user_key")
    )
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_key"))
    _matched, unmatched = quality.check_fk(lines, users, "user_key", "user_key", on_orphan="quarantine")
    return unmatched


@query
def fk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = stored_dims(spark, sf_dir, "dim_date", "dim_user", "dim_product")
    sales = messy_sales(spark, sf_dir, star)
    _final, report = facts.finalize_sales(sales, star["dim_date"], star["dim_user"], star["dim_product"])
    return report


@query
def fk_report_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = stored_dims(spark, sf_dir, "dim_date", "dim_platform")
    spend = messy_spend(spark, sf_dir, star)
    _final, report = facts.finalize_ad_spend(spend, star["dim_date"], star["dim_platform"])
    return report


@query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = stored_dims(spark, sf_dir, "dim_date", "dim_platform", "dim_user", "dim_product")
    return portable(
        quality.quality_report(
            facts.clean_sales(source(spark, sf_dir, "sales_dump")),
            messy_sales(spark, sf_dir, star),
            facts.clean_ad_spend(source(spark, sf_dir, "daily_ad_spend")),
            messy_spend(spark, sf_dir, star),
        )
    )


@query
def rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = quality.sales_rejects(facts.clean_sales(source(spark, sf_dir, "sales_dump")))
    spend = quality.spend_rejects(facts.clean_ad_spend(source(spark, sf_dir, "daily_ad_spend")))
    pooled = sales.select(F.lit("sales_dump").alias("table_name"), "reason").union(
        spend.select(F.lit("daily_ad_spend"), "reason")
    )
    return pooled.groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("rejected"))


@query
def influencer_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.influencer_rejects(source(spark, sf_dir, "influencer_campaigns"))


@query
def unknown_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = dims.dim_user(source(spark, sf_dir, "crm_users_export"))
    return quality.unknown_members(source(spark, sf_dir, "sales_dump"), "user_id", users, "user_id")


GIVEN = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@query
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.table_counts({n: table(spark, sf_dir, n) for n in GIVEN.split()})


# --- reports ------------------------------------------------------------------------------


@query
def report_daily_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(reports.report_daily_performance(event_performance(spark, sf_dir)))


@query
def report_roas_by_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = stored_dims(spark, sf_dir, "dim_date", "dim_platform")
    spend = facts.with_spend_key(messy_spend(spark, sf_dir, star))
    return portable(
        reports.report_roas_by_platform(spend, order_sales(spark, sf_dir), star["dim_platform"])
    )


@query
def report_platform_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_platform_breakdown(report_roas_by_platform(spark, sf_dir))


@query
def report_cac_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(reports.report_cac_over_time(event_performance(spark, sf_dir)))


@query
def report_cac_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    over_time = reports.report_cac_over_time(event_performance(spark, sf_dir))
    summary = portable(reports.report_cac_summary(over_time))
    return summary.withColumn("avg_cac", F.round("avg_cac", 6))


def order_feed(spark: SparkSession, sf_dir: str, sales: DataFrame) -> DataFrame:
    users = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("user_key"), F.col("c_name").alias("full_name")
    )
    products = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_key"), F.col("p_name").alias("product_name")
    )
    return portable(reports.report_sales_feed(sales, users, products))


@query
def report_sales_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_feed(spark, sf_dir, order_sales(spark, sf_dir))


@query
def report_sales_feed_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed from stored sales, of which it opens the newest partitions only."""
    layout = Layout(scratch_path(spark, "feed"))
    dated = order_sales(spark, sf_dir).where(F.col("date_key").isNotNull())
    write_table(with_sales_partition(dated), layout.serving("fact_sales"), layout.sales_partition, "date_key")
    return order_feed(spark, sf_dir, read_latest_sales(spark, layout, DEFAULT_RULES.feed_size))


@query
def report_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(reports.report_daily_sales(order_sales(spark, sf_dir)))


@query
def report_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpis = portable(reports.report_kpis(event_performance(spark, sf_dir)))
    return kpis.withColumns({"avg_roas": F.round("avg_roas", 6), "avg_cac": F.round("avg_cac", 6)})


@query
def report_overall_roas(spark: SparkSession, sf_dir: str) -> DataFrame:
    overall = portable(reports.report_overall_roas(reports.report_kpis(event_performance(spark, sf_dir))))
    return overall.withColumn("overall_roas", F.round("overall_roas", 6))


@query
def report_roas_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = reports.report_daily_performance(event_performance(spark, sf_dir))
    return portable(reports.report_roas_trend(daily))


@query
def total_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_total_sales(order_sales(spark, sf_dir))


# --- sources and sinks --------------------------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    src, dst = scratch_path(spark, "csv"), scratch_path(spark, "raw")
    write_csv_sources(spark, sf_dir, src, [name])
    ingest_raw(spark, src, dst)
    return spark.read.parquet(f"{dst}/{name}").drop(*PROVENANCE)


@query
def raw_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "sales_dump")


@query
def raw_roundtrip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir, "influencer_campaigns")


@query
def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and spend through the export sink as files: text stays text, money stays exact."""
    users = dims.dim_user(source(spark, sf_dir, "crm_users_export"))
    options = {"path": scratch_path(spark, "export"), "header": "true", "emptyValue": '""'}
    export_tables({"dim_user": users}, options, "csv")
    return read_exported(spark, "dim_user", options, "csv")


@query
def export_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "dim_user": dims.dim_user(source(spark, sf_dir, "crm_users_export")),
        "dim_product": dims.dim_product(source(spark, sf_dir, "product_codes")),
        "dim_influencer": dims.dim_influencer(source(spark, sf_dir, "influencer_campaigns")),
    }
    options = {"path": scratch_path(spark, "export")}
    export_tables(tables, options, "parquet")
    return verify_export(spark, tables, options, "parquet")


# --- upserts ------------------------------------------------------------------------------


def _updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders again under doubled ids (half of them taken already) and other amounts."""
    return table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") * 2).cast("string").alias("sale_id"),
        day_key(F.to_date("o_orderdate")).alias("date_key"),
        F.col("o_custkey").cast("int").alias("user_key"),
        F.col("o_custkey").alias("product_key"),
        F.lit("1.25").cast("decimal(12,2)").alias("amount"),
    )


@query
def upsert_sales_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(upsert(order_sales(spark, sf_dir), _updates(spark, sf_dir), ["sale_id"], "insert_new"))


@query
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(upsert(order_sales(spark, sf_dir), _updates(spark, sf_dir), ["sale_id"], "merge"))


@query
def last_update_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments as repeated updates of their order: the last one by day, line and price counts."""
    shipments = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", day_key(F.to_date("l_shipdate")).alias("ship_key"), "l_linenumber", "l_extendedprice"
    )
    return last_by_key(shipments, ["l_orderkey"], ["ship_key", "l_linenumber", "l_extendedprice"])


@query
def refresh_touched_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics stored before the late sales come, then refreshed for just the days those touch."""
    layout = Layout(scratch_path(spark, "refresh"))
    sales = schemas.conform(
        purchases(spark, sf_dir).withColumn("product_key", F.lit(DEFAULT_RULES.unknown_product_key)), "fact_sales"
    )
    daily = impressions(spark, sf_dir).groupBy("date_key").agg(F.sum("total_cost").alias("total_cost"))
    spend = facts.with_spend_key(daily.withColumn("platform_key", F.lit(1)))
    write_snapshot(spend, layout.serving("fact_ad_spend"))
    late = F.col("date_key") >= 20240120
    path = layout.serving("fact_sales")
    write_table(with_sales_partition(sales.where(~late)), path, layout.sales_partition, "date_key")
    stored = metrics.marketing_performance(
        read_sales(spark, layout), read_served(spark, layout, "fact_ad_spend")
    )
    merge_snapshot(
        spark,
        layout.serving("fact_marketing_performance"),
        schemas.conform(stored, "fact_marketing_performance"),
        ["date_key"],
    )
    write_table(
        with_sales_partition(sales.where(late)), path, layout.sales_partition, "date_key", mode="append"
    )
    touched = [row[0] for row in sales.where(late).select("date_key").distinct().collect()]
    refresh_days(spark, layout, touched)
    return portable(read_served(spark, layout, "fact_marketing_performance"))


@query
def serving_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving tables under their names in SQL: monthly totals of sales and spend."""
    layout = Layout(scratch_path(spark, "serving"))
    star = stored_dims(spark, sf_dir, "dim_date", "dim_platform", dst=layout.serving())
    write_snapshot(facts.with_spend_key(messy_spend(spark, sf_dir, star)), layout.serving("fact_ad_spend"))
    write_table(
        with_sales_partition(order_sales(spark, sf_dir)),
        layout.serving("fact_sales"),
        layout.sales_partition,
        "date_key",
    )
    register_views(spark, layout)
    return portable(
        spark.sql(
            """
            with months as (
                select year, month, 'sales' as side, cast(amount as decimal(18,2)) as value
                from fact_sales join dim_date using (date_key)
                union all
                select year, month, platform, total_cost
                from fact_ad_spend join dim_date using (date_key) join dim_platform using (platform_key))
            select year, month, side, count(*) as entries, sum(value) as total
            from months group by year, month, side
            """
        )
    )


# --- streaming ----------------------------------------------------------------------------


def _live_store(spark: SparkSession, sf_dir: str) -> Layout:
    """A lakehouse with dimensions and spend, and no sales yet."""
    layout = Layout(scratch_path(spark, "live"))
    names = ("dim_date", "dim_platform", "dim_user", "dim_product")
    star = stored_dims(spark, sf_dir, *names, dst=layout.serving())
    spend = facts.with_spend_key(messy_spend(spark, sf_dir, star))
    write_snapshot(spend, layout.serving("fact_ad_spend"))
    return layout


def _drain(spark: SparkSession, incoming: str, layout: Layout, files_per_batch: int | None = None) -> None:
    checkpoints = f"{layout.root}/checkpoints"
    for running in watch(spark, incoming, layout, checkpoints, trigger={"availableNow": True}, files_per_batch=files_per_batch):
        running.awaitTermination()


def doubled_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales once more under doubled ids, half of which are taken."""
    number = (F.substring("sale_id", 2, 10).cast("bigint") * 2).cast("string")
    return source(spark, sf_dir, "sales_dump").withColumn("sale_id", F.concat(F.lit("S"), F.lpad(number, 10, "0")))


def _streamed_sales(spark: SparkSession, sf_dir: str) -> Layout:
    """All sales dropped in several files, then dropped again under doubled ids."""
    layout, incoming = _live_store(spark, sf_dir), scratch_path(spark, "incoming")
    sales = source(spark, sf_dir, "sales_dump")
    drop_csv(sales, incoming, "sales_dump_first")
    drop_csv(sales.select("sale_id"), incoming, "unrelated")
    _drain(spark, incoming, layout)
    drop_csv(doubled_sales(spark, sf_dir), incoming, "sales_dump_second")
    _drain(spark, incoming, layout)
    return layout


@query
def stream_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(read_sales(spark, _streamed_sales(spark, sf_dir)))


@query
def stream_sales_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _streamed_sales(spark, sf_dir)
    return portable(read_served(spark, layout, "fact_marketing_performance"))


@query
def metrics_by_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily metrics from what several batches added to their days; no stored sale is read."""
    layout, incoming = _live_store(spark, sf_dir), scratch_path(spark, "incoming")
    drop_csv(source(spark, sf_dir, "sales_dump"), incoming, "sales_dump")
    _drain(spark, incoming, layout, files_per_batch=2)
    return portable(metrics.performance_of(read_measures(spark, layout), read_served(spark, layout, "fact_ad_spend")))


def _three_headers(sales: DataFrame) -> list[DataFrame]:
    """The sales in three parts, whose columns have other orders and, in one part, another column."""
    third = F.pmod(F.xxhash64("sale_id", "timestamp"), F.lit(3))
    first, second, last = [sales.where(F.coalesce(third, F.lit(0)) == i) for i in range(3)]
    return [first, second.select(*reversed(sales.columns)), last.select("amount", F.lit("x").alias("note"), *[c for c in sales.columns if c != "amount"])]


@query
def raw_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table from part files under three headers."""
    src, dst = scratch_path(spark, "csv"), scratch_path(spark, "raw")
    for part in _three_headers(source(spark, sf_dir, "sales_dump")):
        part.write.mode("append").options(**CSV_OPTIONS).csv(f"{src}/sales_dump.csv")
    ingest_raw(spark, src, dst)
    return spark.read.parquet(f"{dst}/sales_dump").select(*schemas.SOURCES["sales_dump"].fieldNames())


@query
def stream_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales dropped under three headers, beside files that lack a column, which are rejects."""
    layout, incoming = _live_store(spark, sf_dir), scratch_path(spark, "incoming")
    sales = source(spark, sf_dir, "sales_dump")
    for number, part in enumerate(_three_headers(sales)):
        drop_csv(part, incoming, f"sales_dump_{number}")
    drop_csv(sales.drop("amount"), incoming, "sales_dump_without_amount")
    _drain(spark, incoming, layout)
    return portable(read_sales(spark, layout))


class _Lost(Exception):
    """Stands for the loss of the driver within a batch."""


@query
def replayed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales in batches that each die after another of their steps and are repeated, and repeated again."""
    layout = _live_store(spark, sf_dir)
    sales = source(spark, sf_dir, "sales_dump").select("*", F.lit("a.csv").alias("file_path"), F.lit("2024-01-01").cast("timestamp").alias("file_time"))
    steps = ("claimed", "appended", "measured")
    for number, last in enumerate(steps):

        def die(step: str, last: str = last) -> None:
            if step == last:
                raise _Lost(step)

        batch = sales.where(F.pmod(F.xxhash64(F.coalesce("sale_id", "timestamp")), F.lit(len(steps))) == number)
        with contextlib.suppress(_Lost):
            process_sales(batch, layout, number, stream="replayed", after=die)
        process_sales(batch, layout, number, stream="replayed")
        process_sales(batch, layout, number, stream="replayed")
    return portable(read_sales(spark, layout))


@query
def stream_ad_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New spend for other days, then corrected totals for all the stored days."""
    layout, incoming = _live_store(spark, sf_dir), scratch_path(spark, "incoming")
    star = {n: read_served(spark, layout, n) for n in ("dim_user", "dim_product")}
    sales = messy_sales(spark, sf_dir, star)
    write_table(
        with_sales_partition(facts.with_product_fallback(sales)),
        layout.serving("fact_sales"),
        layout.sales_partition,
        "date_key",
    )
    # Each file is a complete statement of its days, so a day goes to one file.
    day = F.coalesce(parse_ambiguous_date(F.col("event_date")).cast("string"), F.xxhash64("event_date", "cost").cast("string"))
    drop_csv(source(spark, sf_dir, "event_spend"), incoming, "daily_ad_spend_new", day)
    _drain(spark, incoming, layout)
    corrected = source(spark, sf_dir, "daily_ad_spend").withColumn("cost", F.lit("2.5"))
    drop_csv(corrected, incoming, "daily_ad_spend_corrected", day)
    _drain(spark, incoming, layout)
    return portable(read_served(spark, layout, "fact_ad_spend"))


# --- the whole run ------------------------------------------------------------------------

CSV_SOURCES = list(schemas.SOURCES)


def _full_run(spark: SparkSession, sf_dir: str) -> Layout:
    src, layout = scratch_path(spark, "sources"), Layout(scratch_path(spark, "lakehouse"))
    write_csv_sources(spark, sf_dir, src, CSV_SOURCES)
    run_pipeline(spark, src, layout)
    return layout


@query
def end_to_end_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = _full_run(spark, sf_dir)
    return portable(read_served(spark, layout, "fact_marketing_performance"))


@query
def end_to_end_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the serving tables after a second run over the same sources."""
    src, layout = scratch_path(spark, "sources"), Layout(scratch_path(spark, "lakehouse"))
    write_csv_sources(spark, sf_dir, src, CSV_SOURCES)
    run_pipeline(spark, src, layout)
    run_pipeline(spark, src, layout)
    tables, _missing = served_tables(spark, layout)
    return quality.table_counts(tables)


@query
def rerun_after_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily metrics after a batch run, drops of all sales under doubled ids, and a second batch run."""
    src, layout = scratch_path(spark, "sources"), Layout(scratch_path(spark, "lakehouse"))
    write_csv_sources(spark, sf_dir, src, CSV_SOURCES)
    run_pipeline(spark, src, layout)
    incoming = scratch_path(spark, "incoming")
    drop_csv(doubled_sales(spark, sf_dir), incoming, "sales_dump_doubled")
    _drain(spark, incoming, layout)
    run_pipeline(spark, src, layout)
    return portable(read_served(spark, layout, "fact_marketing_performance"))


@query
def late_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live sales of users who are listed only by the next batch run: each has its user after it."""
    src, layout = scratch_path(spark, "sources"), Layout(scratch_path(spark, "lakehouse"))
    write_csv_sources(spark, sf_dir, src, [n for n in CSV_SOURCES if n not in ("sales_dump", "crm_users_export")])
    sales, users = source(spark, sf_dir, "sales_dump"), source(spark, sf_dir, "crm_users_export")
    early = F.pmod(F.xxhash64(F.trim("user_id")), F.lit(2)) == 0
    users.where(early).write.options(**CSV_OPTIONS).csv(f"{src}/crm_users_export.csv")
    sales.limit(0).write.options(**CSV_OPTIONS).csv(f"{src}/sales_dump.csv")
    run_pipeline(spark, src, layout)
    incoming = scratch_path(spark, "incoming")
    drop_csv(sales, incoming, "sales_dump")
    _drain(spark, incoming, layout)
    users.where(~early).write.mode("append").options(**CSV_OPTIONS).csv(f"{src}/crm_users_export.csv")
    run_pipeline(spark, src, layout)
    known = read_served(spark, layout, "dim_user").select("user_key", "user_id")
    return portable(read_sales(spark, layout).join(known, "user_key").select("sale_id", "date_key", "user_id", "amount"))
