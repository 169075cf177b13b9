"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def builder(app_name: str = "roastery") -> SparkSession.Builder:
    """Builder with the settings above; master, memory and partitions stay the caller's."""
    session_builder = SparkSession.builder.appName(app_name)
    for name, value in SETTINGS.items():
        session_builder = session_builder.config(name, value)
    return session_builder
