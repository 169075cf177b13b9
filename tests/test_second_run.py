"""The counts after a second run are those of a second run: it publishes the tables that are counted."""

from __future__ import annotations

from pyspark.sql import functions as F

from roastery import schemas
from roastery.operators.quality import table_counts
from roastery.plans.lakehouse import current, published, read_served, served_tables
from workload import queries
from workload.drops import CSV_OPTIONS


def test_tables_that_are_counted_are_those_of_a_second_whole_run(spark, sf_dir, tmp_path, monkeypatch):
    members = {
        "product_codes": [("P1", "Mug", "$2.00")],
        "daily_ad_spend": [("15/01/2026", "fb", "1.5"), ("16/01/2026", "fb", "2")],
        "raw_web_leads": [("organic", "15/01/2026")],
        "sales_dump": [("1", "u1", "Mug", "$4", "2026-01-15 10:00:00"), ("2", None, "Hat", "$5", "2026-01-16 10:00:00")],
        "website_interactions": [("2026-01-15 10:00:00",)],
        "crm_users_export": [("u1", "Ann", None, None)],
        "influencer_campaigns": [("I1", "R", None)],
    }
    runs, seen = [], {}

    def write(spark, _sf_dir, src, names):
        for name in names:
            spark.createDataFrame(members[name], schemas.SOURCES[name]).write.options(**CSV_OPTIONS).csv(f"{src}/{name}.csv")

    def run(spark, src, layout):
        rows, reports = whole_run(spark, src, layout)
        runs.append((current(spark, layout).generation, rows))
        return rows, reports

    def served(spark, layout):
        seen["layout"] = layout
        return served_tables(spark, layout)

    whole_run = queries.run_pipeline
    monkeypatch.setattr(queries, "write_csv_sources", write)
    monkeypatch.setattr(queries, "run_pipeline", run)
    monkeypatch.setattr(queries, "served_tables", served)
    counts = {r["table_name"]: r["row_count"] for r in queries.QUERIES["end_to_end_counts"](spark, sf_dir).collect()}

    generations = [name for name, _ in published(spark, seen["layout"])]
    assert [g for g, _ in runs] == generations and len(set(generations)) == 2
    second = runs[1][1]
    assert counts == {name: second[name] for name in counts}
    assert second["raw_sales_dump"] == counts["fact_sales"] == 2 and counts["fact_marketing_performance"] == 2
    # Every table that is counted is in the second run's generation.
    latest = current(spark, seen["layout"])
    tables = {name: read_served(spark, latest, name) for name in counts}
    assert all(generations[1] in f for df in tables.values() for f in df.inputFiles())
    assert {r["table_name"]: r["row_count"] for r in table_counts(tables).where(F.col("row_count") > 0).collect()} == counts
