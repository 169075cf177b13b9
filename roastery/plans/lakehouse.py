"""The layers of a lakehouse, and the whole batch run in its fixed order.

The serving layer is published by generations: a run writes its tables aside, carries over
what the live streams added since, and switches one pointer last.  Readers
have the former generation until then, and for a day after it.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roastery import schemas
from roastery.functions import one_of
from roastery.operators import dims, facts, quality
from roastery.operators.key_index import KeyIndex, build, open_index
from roastery.operators.metrics import add_up, daily_measures, marketing_performance, performance_of, refresh_performance
from roastery.operators.upsert import merge_snapshot
from roastery.rules import DEFAULT_RULES, SERVING_KEYS, Rules
from roastery.sources.export import export_tables
from roastery.sources.raw import ingest_raw
from roastery.storage import (
    KEEP_HOURS,
    delete_folder,
    head,
    list_folder,
    materialize,
    path_exists,
    read_snapshot,
    read_table,
    read_text,
    scratch_scope,
    side_by_side,
    table_exists,
    write_snapshot,
    write_table,
    write_text,
)

# One row per day, or per platform and day: small at any volume, kept as snapshots.
SNAPSHOT_TABLES = ("fact_ad_spend", "fact_marketing_performance")
#: Batches of day measures that are added up when read; beyond, they are folded into their base.
OPEN_DELTAS = 32
#: Parts of live sales of one size that are merged into a larger one.
FAN_IN = 8
_turns: dict[str, threading.RLock] = {}
_turns_guard = threading.Lock()


@dataclass(frozen=True)
class Layout:
    """Where the layers of one lakehouse are, and how its sales are partitioned.

    Sales are partitioned by month and, within, clustered by day, so a scan of
    one day opens one month and skips most of its row groups.  Where a day
    holds gigabytes, ``sales_partition="date_key"`` gives it a partition of its own.
    """

    root: str
    sales_partition: str = "month_key"
    generation: str | None = None  # of the serving layer; None: the published one, or one that has no generations

    def raw(self, table: str = "") -> str:
        return f"{self.root}/raw/{table}".rstrip("/")

    def conformed(self, table: str = "") -> str:
        return f"{self.root}/conformed/{table}".rstrip("/")

    def serving(self, table: str = "") -> str:
        inner = f"{self.generation}/{table}" if self.generation else table
        return f"{self.root}/serving/{inner}".rstrip("/")

    def rejects(self, table: str = "") -> str:
        return f"{self.root}/rejects/{table}".rstrip("/")

    def ledger(self) -> str:
        return f"{self.root}/ledger"


def published(spark: SparkSession, layout: Layout) -> list[tuple[str, float]]:
    """Generations that have been published and when, the current one last."""
    manifest = read_text(spark, f"{layout.root}/serving/GENERATIONS")
    return [tuple(entry) for entry in json.loads(manifest)] if manifest else []


def current(spark: SparkSession, layout: Layout) -> Layout:
    """``layout`` with its generation settled: what is read or changed through it stays in that one."""
    if layout.generation is not None:
        return layout
    known = published(spark, layout)
    return replace(layout, generation=known[-1][0]) if known else layout


def new_generation(layout: Layout) -> Layout:
    """A generation of its own, that nobody reads until it is published."""
    return replace(layout, generation=f"generation-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")


def publish(spark: SparkSession, layout: Layout, keep_hours: float = KEEP_HOURS) -> None:
    """Make a finished generation the one that is read; delete those replaced ``keep_hours`` ago.

    One small file is replaced, so readers find the former generation or this one, each whole.
    Generations of runs that died are deleted by age.
    """
    known, now = published(spark, layout), time.time()
    oldest = now - 3600 * keep_hours
    # A generation was replaced when the next one was published.
    kept = [entry for entry, (_, until) in zip(known, known[1:] + [("", now)]) if until >= oldest]
    write_text(spark, f"{layout.root}/serving/GENERATIONS", json.dumps([*kept, (layout.generation, now)]))
    names = {name for name, _ in kept} | {layout.generation}
    for name in list_folder(spark, f"{layout.root}/serving"):
        if name.startswith("generation-") and name not in names and int(name.split("-")[1]) / 1e9 < oldest:
            delete_folder(spark, f"{layout.root}/serving/{name}")


@contextmanager
def turn(layout: Layout) -> Iterator[None]:
    """Live batches and the publication of a run take turns on a lakehouse.

    This holds within one driver; a batch run in another must not overlap with live streams.
    """
    with _turns_guard:
        lock = _turns.setdefault(layout.root, threading.RLock())
    with lock:
        yield


def with_sales_partition(sales: DataFrame) -> DataFrame:
    return sales.withColumn("month_key", F.expr("date_key div 100").cast("int"))


def _live_folder(layout: Layout) -> str:
    return layout.serving("_live_sales")


def _live_state(spark: SparkSession, layout: Layout) -> dict:
    """``merged``: the merged parts that are read.  ``replaced``: parts that these hold, and since when."""
    state = read_text(spark, f"{_live_folder(layout)}/PARTS")
    return json.loads(state) if state else {"merged": [], "replaced": {}}


def live_parts(spark: SparkSession, layout: Layout) -> list[str]:
    """Names of the parts that live sales are read from: merged ones, and batches that none of them holds yet."""
    folder = _live_folder(layout)
    if not path_exists(spark, folder):
        return []
    state = _live_state(spark, layout)
    there = [n.removeprefix("part=") for n in list_folder(spark, folder) if n.startswith("part=")]
    batches = [n for n in there if n.startswith("b-") and n not in state["replaced"] and table_exists(spark, f"{folder}/part={n}")]
    return [n for n in state["merged"] if n in there] + batches


def _read_parts(spark: SparkSession, layout: Layout, parts: list[str]) -> DataFrame:
    folder = _live_folder(layout)
    schema = T.StructType([*schemas.STORED_SALES.fields, T.StructField("part", T.StringType())])
    rows = spark.read.schema(schema).option("basePath", folder).parquet(*[f"{folder}/part={n}" for n in parts])
    return rows.select(*schemas.STORED_SALES.fieldNames())


def stored_sales(spark: SparkSession, layout: Layout) -> DataFrame:
    """The served sales with their partition, their origin and their pending names: of the batch run, and live ones."""
    layout = current(spark, layout)
    path, parts = layout.serving("fact_sales"), live_parts(spark, layout)
    if not parts:
        return read_table(spark, path, schemas.STORED_SALES)
    live = _read_parts(spark, layout, parts)
    return read_table(spark, path, schemas.STORED_SALES).unionByName(live) if path_exists(spark, path) else live


def has_sales(spark: SparkSession, layout: Layout) -> bool:
    layout = current(spark, layout)
    return path_exists(spark, layout.serving("fact_sales")) or bool(live_parts(spark, layout))


def append_live(spark: SparkSession, layout: Layout, sales: DataFrame, claim: str) -> int:
    """Store a batch's sales as a part of its own, under its claim; returns how many were added.

    A part that is complete stays as it is, so the same batch again adds nothing.  It is clustered by
    partition, not by day: a batch has few rows of many months, and as many files as months will do.
    """
    path = f"{_live_folder(layout)}/part=b-{claim}"
    if table_exists(spark, path):
        return 0
    return write_table(with_sales_partition(sales), path, layout.sales_partition)


def merge_parts(spark: SparkSession, layout: Layout, claim: str, keep_hours: float = KEEP_HOURS) -> list[str]:
    """Unite small parts: ``FAN_IN`` batches to a part, ``FAN_IN`` of these to a larger one, and so on; returns the parts now read.

    So each sale is rewritten a number of times that is logarithmic in the number of batches, and as many
    parts are read.  The batch ``claim`` and those of other streams are left alone, since they may be
    repeated.  The parts that a merge replaces stay ``keep_hours`` for readers that have them open.
    """
    folder, state = _live_folder(layout), _live_state(spark, layout)
    stream = claim.rsplit("-", 1)[0]
    parts = live_parts(spark, layout)
    done = [n for n in parts if n.startswith("b-") and n.removeprefix("b-").rsplit("-", 1)[0] == stream and n < f"b-{claim}"]
    tier = 0
    while len(done) >= FAN_IN:
        name = f"m{tier + 1}-{uuid.uuid4().hex}"
        rows = _read_parts(spark, layout, done)
        write_table(rows, f"{folder}/part={name}", layout.sales_partition, "date_key")
        state["merged"] = [n for n in state["merged"] if n not in done] + [name]
        state["replaced"] |= {n: time.time() for n in done}
        write_text(spark, f"{folder}/PARTS", json.dumps(state))
        tier += 1
        done = [n for n in state["merged"] if n.startswith(f"m{tier}-")]
    oldest = time.time() - 3600 * keep_hours
    expired = [n for n, since in state["replaced"].items() if since < oldest]
    for name in expired:
        delete_folder(spark, f"{folder}/part={name}")
    if expired:
        state["replaced"] = {n: since for n, since in state["replaced"].items() if n not in expired}
        write_text(spark, f"{folder}/PARTS", json.dumps(state))
    return live_parts(spark, layout)


def read_sales(spark: SparkSession, layout: Layout, date_keys: list[int] | None = None) -> DataFrame:
    """The served sales, all or those of the given days."""
    sales = stored_sales(spark, layout)
    if date_keys is not None:
        months = sorted({day // 100 for day in date_keys})
        sales = sales.where(one_of("month_key", months) & one_of("date_key", date_keys))
    return sales.select(*schemas.STAR["fact_sales"].fieldNames())


def read_latest_sales(spark: SparkSession, layout: Layout, n: int) -> DataFrame:
    """The served sales of the newest partitions that together hold n of them (all sales if there are fewer).

    The partitions are known from their folder names, so a feed of the latest
    sales opens the last of them and, only if that has too few rows, twice as many.
    """
    layout = current(spark, layout)
    column, base = layout.sales_partition, layout.serving("fact_sales")
    folders = [base] if path_exists(spark, base) else []
    folders += [f"{_live_folder(layout)}/part={n}" for n in live_parts(spark, layout)]
    prefix = f"{column}="
    values = {n.removeprefix(prefix) for folder in folders for n in list_folder(spark, folder) if n.startswith(prefix)}
    newest = sorted((int(v) for v in values if v.isdigit()), reverse=True)
    opened = 1
    while True:
        sales = stored_sales(spark, layout)
        if opened < len(newest):
            sales = sales.where(F.col(column) >= newest[opened - 1])
        sales = sales.select(*schemas.STAR["fact_sales"].fieldNames())
        if opened >= len(newest) or sales.limit(n).count() == n:
            return sales
        opened *= 2


def read_served(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """A serving table as it is now."""
    layout = current(spark, layout)
    if name == "fact_sales":
        return read_sales(spark, layout)
    if name in SNAPSHOT_TABLES:
        return read_snapshot(spark, layout.serving(name), schemas.STAR[name])
    return read_table(spark, layout.serving(name), schemas.STAR[name])


def served_tables(spark: SparkSession, layout: Layout) -> tuple[dict[str, DataFrame], list[str]]:
    """All serving tables that are there, and the names of those that are not."""
    layout = current(spark, layout)
    present = [n for n in SERVING_KEYS if path_exists(spark, layout.serving(n)) or (n == "fact_sales" and has_sales(spark, layout))]
    missing = [n for n in SERVING_KEYS if n not in present]
    return {n: read_served(spark, layout, n) for n in present}, missing


def register_views(spark: SparkSession, layout: Layout) -> list[str]:
    """Make the serving tables queryable by name in SQL, as they are now; returns the names."""
    tables, _missing = served_tables(spark, layout)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


# --- what live batches keep beside the tables ---------------------------------------------


def sales_index(spark: SparkSession, layout: Layout) -> KeyIndex:
    """The index of the sale ids, built from the stored sales if there is none yet."""
    layout = current(spark, layout)
    root = layout.serving("_keys/fact_sales")
    known = open_index(spark, root)
    if known is not None:
        return known
    if has_sales(spark, layout):
        return build(stored_sales(spark, layout).select("sale_id"), "sale_id", root)
    nothing = spark.createDataFrame([], "sale_id string")
    return build(nothing, "sale_id", root, expected=0)


def _measures(layout: Layout) -> str:
    return layout.serving("_measures")


def ensure_measures(spark: SparkSession, layout: Layout, rules: Rules = DEFAULT_RULES) -> None:
    """Add up the stored sales per day once; from then on batches add what they bring."""
    layout = current(spark, layout)
    if head(spark, _measures(layout)) is None:
        base = daily_measures(read_sales(spark, layout), rules) if has_sales(spark, layout) else spark.createDataFrame([], schemas.MEASURES)
        write_snapshot(_typed(base), _measures(layout), note="[]")


def _typed(measures: DataFrame) -> DataFrame:
    return measures.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.MEASURES.fields])


def _open_deltas(spark: SparkSession, layout: Layout) -> list[str]:
    """Batches whose measures are not in the base yet."""
    folder = f"{_measures(layout)}/deltas"
    if not path_exists(spark, folder):
        return []
    _, note = head(spark, _measures(layout))
    folded = set(json.loads(note or "[]"))
    return [n for n in list_folder(spark, folder) if n not in folded and table_exists(spark, f"{folder}/{n}")]


def read_measures(spark: SparkSession, layout: Layout, date_keys: list[int] | None = None) -> DataFrame:
    """One row per day of what its sales add up to, from the base and the batches since; no sale is read."""
    layout = current(spark, layout)
    folder = _measures(layout)
    parts = read_snapshot(spark, folder, schemas.MEASURES)
    deltas = _open_deltas(spark, layout)
    if deltas:
        parts = parts.unionByName(spark.read.schema(schemas.MEASURES).parquet(*[f"{folder}/deltas/{n}" for n in deltas]))
    if date_keys is not None:
        parts = parts.where(one_of("date_key", date_keys))
    return add_up(parts)


def add_measures(spark: SparkSession, layout: Layout, sales: DataFrame, claim: str, rules: Rules = DEFAULT_RULES) -> None:
    """Store what a batch adds to its days under its claim, ``stream-number``; the same batch again replaces it.

    Once there are ``OPEN_DELTAS`` of these, those of the stream's earlier batches, which are never repeated,
    are folded into the base.  The base names what it has taken in, so nothing counts twice if
    the run dies before it is deleted.
    """
    layout = current(spark, layout)
    folder = _measures(layout)
    write_table(_typed(daily_measures(sales, rules)), f"{folder}/deltas/{claim}")
    deltas = _open_deltas(spark, layout)
    stream = claim.rsplit("-", 1)[0]
    earlier = [n for n in deltas if n.rsplit("-", 1)[0] == stream and n < claim]
    if len(deltas) < OPEN_DELTAS or not earlier:
        return
    _, note = head(spark, folder)
    there = set(list_folder(spark, f"{folder}/deltas"))
    folded = [n for n in json.loads(note or "[]") if n in there] + earlier
    whole = spark.read.schema(schemas.MEASURES).parquet(*[f"{folder}/deltas/{n}" for n in earlier])
    base = read_snapshot(spark, folder, schemas.MEASURES).unionByName(whole)
    write_snapshot(_typed(add_up(base)), folder, note=json.dumps(folded))
    for name in folded:
        delete_folder(spark, f"{folder}/deltas/{name}")


def refresh_days(
    spark: SparkSession, layout: Layout, date_keys: list[int], rules: Rules = DEFAULT_RULES
) -> int:
    """Bring the stored metrics of the given days up to date.

    From the measures that live batches keep, if there are any: then no sale is read, however many a
    day has.  Otherwise from the sales of these days.
    """
    if not date_keys:
        return 0
    layout = current(spark, layout)
    spend = read_served(spark, layout, "fact_ad_spend")
    if head(spark, _measures(layout)) is not None:
        daily = performance_of(read_measures(spark, layout, date_keys), spend.where(one_of("date_key", date_keys)), rules)
    else:
        daily = refresh_performance(read_sales(spark, layout, date_keys), spend, date_keys, rules)
    return merge_snapshot(
        spark,
        layout.serving("fact_marketing_performance"),
        schemas.conform(daily, "fact_marketing_performance"),
        ["date_key"],
    )


def known_members(spark: SparkSession, layout: Layout, table: str) -> DataFrame | None:
    """The dimension of the run before, from whichever layer holds a complete copy.

    The conformed copy is rewritten first, from the serving copy; should a run
    die in between, one of the two is always whole.
    """
    for path in (current(spark, layout).serving(table), layout.conformed(table)):
        if table_exists(spark, path):
            return read_table(spark, path, schemas.STAR[table])
    return None


def build_dims(
    spark: SparkSession, layout: Layout, rules: Rules = DEFAULT_RULES, keep_keys: bool = True
) -> dict[str, int]:
    """All dimensions from the raw tables into the conformed layer."""

    def raw(table: str) -> DataFrame:
        return read_table(spark, layout.raw(table))

    def known(table: str) -> DataFrame | None:
        return known_members(spark, layout, table) if keep_keys else None

    spend, leads = raw("daily_ad_spend"), raw("raw_web_leads")
    dates = dims.calendar_dates(raw("sales_dump"), raw("website_interactions"), spend, leads, rules)
    builders = {
        "dim_product": lambda: dims.dim_product(raw("product_codes"), known("dim_product"), rules),
        "dim_platform": lambda: dims.dim_platform(spend, leads, rules, known("dim_platform")),
        "dim_date": lambda: dims.dim_date(*dates),
        "dim_user": lambda: dims.dim_user(raw("crm_users_export"), known("dim_user"), rules),
        "dim_influencer": lambda: dims.dim_influencer(raw("influencer_campaigns"), known("dim_influencer")),
    }

    def store(name: str) -> int:
        return write_table(builders[name](), layout.conformed(name))

    return side_by_side(spark, {name: partial(store, name) for name in builders})


def build_facts(spark: SparkSession, layout: Layout, rules: Rules = DEFAULT_RULES) -> dict[str, int]:
    """Both conformed facts, from raw tables and conformed dimensions."""

    def dim(name: str) -> DataFrame:
        return read_table(spark, layout.conformed(name), schemas.STAR[name])

    def spend() -> int:
        fact = facts.fact_ad_spend(
            read_table(spark, layout.raw("daily_ad_spend")), dim("dim_date"), dim("dim_platform"), rules
        )
        return write_table(fact, layout.conformed("fact_ad_spend"))

    def sales() -> int:
        fact = facts.fact_sales(
            read_table(spark, layout.raw("sales_dump")), dim("dim_user"), dim("dim_product"), rules
        )
        return write_table(fact, layout.conformed("fact_sales"))

    return side_by_side(spark, {"conformed_ad_spend": spend, "conformed_sales": sales})


def store_batch_rejects(
    spark: SparkSession, layout: Layout, rules: Rules = DEFAULT_RULES
) -> dict[str, int]:
    """Unusable rows of the raw facts and of the influencers' metadata, one row per reason, replaced by every run."""
    sales = facts.clean_sales(read_table(spark, layout.raw("sales_dump")), rules)
    spend = facts.clean_ad_spend(read_table(spark, layout.raw("daily_ad_spend")), rules)
    rejected = {
        "sales_dump": quality.sales_rejects(sales),
        "daily_ad_spend": quality.spend_rejects(spend),
        "influencer_campaigns": quality.influencer_rejects(read_table(spark, layout.raw("influencer_campaigns"))),
    }

    def store(name: str) -> int:
        kept = rejected[name].select(*schemas.SOURCES[name].fieldNames(), "reason")
        return write_table(kept, layout.rejects(f"batch/{name}"))

    return side_by_side(spark, {f"rejects_{name}": partial(store, name) for name in rejected})


def live_sales(spark: SparkSession, layout: Layout) -> DataFrame | None:
    """Stored sales that a live batch brought; None if there are no sales."""
    if not has_sales(spark, layout):
        return None
    return stored_sales(spark, layout).where(F.col("origin") == schemas.LIVE)


def live_spend(spark: SparkSession, layout: Layout) -> DataFrame | None:
    if head(spark, layout.serving("fact_ad_spend")) is None:
        return None
    stored = read_snapshot(spark, layout.serving("fact_ad_spend"), schemas.STORED_SPEND)
    return stored.where(F.col("origin") == schemas.LIVE)


def carry_over(spark: SparkSession, former: Layout, fresh: Layout, rules: Rules = DEFAULT_RULES) -> dict[str, int]:
    """Take live sales and spend that the sources of a run lack into its generation; returns how many of each.

    A sale id or a platform day that the sources have counts as they have it.  Sales that named a
    user or product nobody knew get the keys of members that are there now.  Days
    of what is carried over join the calendar.
    """
    counts = {"live_sales": 0, "live_spend": 0}
    days: list[DataFrame] = []
    sales = live_sales(spark, former)
    if sales is not None:
        unseen = sales.join(stored_sales(spark, fresh).select("sale_id"), "sale_id", "left_anti").select(*schemas.STORED_SALES.fieldNames())
        keyed = facts.rekey_sales(unseen, read_served(spark, fresh, "dim_user"), read_served(spark, fresh, "dim_product"), rules)
        kept = materialize(keyed, "live-sales")
        counts["live_sales"] = write_table(kept, fresh.serving("fact_sales"), fresh.sales_partition, "date_key", mode="append")
        days.append(kept.select("date_key"))
    spend = live_spend(spark, former)
    if spend is not None:
        batch = read_snapshot(spark, fresh.serving("fact_ad_spend"), schemas.STORED_SPEND)
        kept = materialize(spend.join(batch.select("date_key", "platform_key"), ["date_key", "platform_key"], "left_anti"), "live-spend")
        counts["live_spend"] = kept.count()
        if counts["live_spend"]:
            merge_snapshot(spark, fresh.serving("fact_ad_spend"), kept.select(*schemas.STORED_SPEND.fieldNames()), ["date_key", "platform_key"])
        days.append(kept.select("date_key"))
    for found in days:
        dates = found.distinct().select(F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").alias("full_date"))
        missing = materialize(dims.new_days(dates, read_served(spark, fresh, "dim_date")), "live-days")
        if not missing.isEmpty():
            write_table(missing, fresh.serving("dim_date"), mode="append")
    return counts


def build_serving(
    spark: SparkSession, layout: Layout, rules: Rules = DEFAULT_RULES
) -> tuple[dict[str, int], dict[str, DataFrame]]:
    """A new generation of the serving layer: promoted dimensions, finalized facts, live rows, daily metrics.

    Returns rows per table and the foreign-key report of each fact.  Until the end, when the
    generation is published, readers have the former one; a run that dies leaves it as it was.
    """
    fresh = new_generation(layout)
    rows = dims.promote_dims(spark, schemas.DIMENSIONS, layout.conformed(), fresh.serving())

    def served(name: str) -> DataFrame:
        return read_served(spark, fresh, name)

    spend, spend_keys = facts.finalize_ad_spend(
        read_table(spark, layout.conformed("fact_ad_spend")), served("dim_date"), served("dim_platform")
    )
    sales, sales_keys = facts.finalize_sales(
        read_table(spark, layout.conformed("fact_sales")),
        served("dim_date"),
        served("dim_user"),
        served("dim_product"),
        rules,
    )
    rows |= side_by_side(
        spark,
        {
            "fact_ad_spend": lambda: write_snapshot(with_origin(spend, None), fresh.serving("fact_ad_spend")),
            "fact_sales": lambda: write_table(
                with_sales_partition(sales), fresh.serving("fact_sales"), fresh.sales_partition, "date_key"
            ),
        },
    )
    with turn(layout):
        former = current(spark, layout)
        if former.generation or has_sales(spark, former):
            carried = carry_over(spark, former, fresh, rules)
            rows |= carried
            rows["fact_ad_spend"] += carried["live_spend"]
            rows["fact_sales"] += carried["live_sales"]
        daily = marketing_performance(served("fact_sales"), served("fact_ad_spend"), rules)
        rows["fact_marketing_performance"] = write_snapshot(
            schemas.conform(daily, "fact_marketing_performance"),
            fresh.serving("fact_marketing_performance"),
        )
        publish(spark, fresh)
    daily_keys = quality.fk_report(
        served("fact_marketing_performance"), {"date_key": (served("dim_date"), "date_key")}
    )
    reports = {
        "fact_ad_spend": spend_keys,
        "fact_sales": sales_keys,
        "fact_marketing_performance": daily_keys,
    }
    return rows, reports


def with_origin(df: DataFrame, origin: str | None) -> DataFrame:
    return df.withColumn("origin", F.lit(origin).cast("string"))


def export_served(
    spark: SparkSession, layout: Layout, options: Mapping[str, str], fmt: str = "jdbc"
) -> tuple[list[str], list[str]]:
    """Export the serving tables that are there; returns their names, and those of the tables skipped as absent."""
    tables, missing = served_tables(spark, layout)
    return export_tables(tables, options, fmt), missing


def run_pipeline(
    spark: SparkSession,
    src: str,
    dst: str | Layout,
    rules: Rules = DEFAULT_RULES,
    export_options: Mapping[str, str] | None = None,
    export_format: str = "jdbc",
    multi_line: dict[str, bool] | None = None,
    keep_rejects: bool = False,
) -> tuple[dict[str, int], dict[str, DataFrame]]:
    """CSV folder to serving tables, and to a relational store if options are given.

    ``keep_rejects`` also stores the rows that could not be used, with the
    reasons, at the price of another pass over the raw facts; how many there are
    is in the reports either way.  Returns rows written per table and the foreign-key reports, which are lazy.
    """
    layout = dst if isinstance(dst, Layout) else Layout(dst)
    with scratch_scope(spark, "run"):
        rows = {f"raw_{t}": n for t, n in ingest_raw(spark, src, layout.raw(), multi_line).items()}
        rows.update(build_dims(spark, layout, rules))
        rows.update(build_facts(spark, layout, rules))
        if keep_rejects:
            rows.update(store_batch_rejects(spark, layout, rules))
        served, reports = build_serving(spark, layout, rules)
        rows.update(served)
        if export_options is not None:
            export_served(spark, layout, export_options, export_format)
    return rows, reports
