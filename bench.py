"""Headline queries, timed: prints one JSON line.

BENCH_SF_DIR   folder of the given tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names instead of the headline list
"""

from __future__ import annotations

import json
import os
import time

from roastery.session import builder
from workload.messy import SOURCES, source
from workload.queries import QUERIES

HEADLINE = [
    "marketing_performance",
    "performance_outer_days",
    "paying_users_distinct",
    "amount_usd",
    "ambiguous_date",
    "calendar",
    "dim_user",
    "dim_product",
    "dim_influencer",
    "fact_ad_spend",
    "fact_sales",
    "fact_sales_shuffled",
    "fk_report",
    "fk_orphan_rows",
    "quality_report",
    "report_roas_by_platform",
    "report_sales_feed",
    "report_daily_sales",
    "report_kpis",
    "raw_roundtrip",
    "upsert_sales_insert_only",
    "upsert_merge",
    "refresh_touched_days",
    "stream_sales",
    "end_to_end_performance",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = (
        builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Raw tables are there before queries run: deriving them is not part of any.
    for name in SOURCES:
        source(spark, sf_dir, name).count()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
