"""Derived sources: spread over the cores if their tables have few splits, else written where they are read."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from workload import messy


@pytest.mark.parametrize("files", [1, 16])
def test_rows_are_shuffled_only_if_splits_are_few(spark, tmp_path, files):
    given = spark.range(1000).select(F.col("id").alias("event_id"), F.lit("2024-01-02 03:04:00").cast("timestamp").alias("ts"))
    given.repartition(files).write.parquet(str(tmp_path / "events.parquet"))
    spark.conf.set("spark.sql.files.openCostInBytes", 1 << 27)  # a file is a split
    try:
        found = messy.source(spark, str(tmp_path), "website_interactions")
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found.count() == 1000 and found.distinct().collect()[0]["ts"] == "2024-01-02 03:04:00"
    parts = {re.search(r"part-(\d+)", f)[1] for f in found.inputFiles()}
    assert len(parts) == max(files, spark.sparkContext.defaultParallelism)
