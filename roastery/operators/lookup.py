"""Attach a dimension's key to facts, whatever the size of either and however skewed.

A small dimension, small being measured, is broadcast.  Beyond that the join
shuffles, and the keys that hold the most rows are taken out of the shuffle
first: the busiest keys form a table of fixed length that is broadcast, so each
key left for the shuffle holds less than ``1/HOT_KEYS`` of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roastery.storage import materialize

HOT_KEYS = 1000
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 32


def unique_lookup(members: DataFrame, member_col: str, key_col: str) -> DataFrame:
    """(member, key) with each member once, so that a join can never multiply facts."""
    return (
        members.where(F.col(member_col).isNotNull())
        .groupBy(F.col(member_col).alias("_member"))
        .agg(F.min(key_col).alias("_key"))
    )


def fits_broadcast(lookup: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a (member, key) table: text bytes plus a fixed cost per row."""
    size = lookup.agg(
        F.coalesce(
            F.sum(F.octet_length(F.col("_member").cast("string")) + F.lit(ROW_OVERHEAD)), F.lit(0)
        ).alias("bytes")
    )
    return size.first()["bytes"] <= limit_bytes


def attach_key(
    facts: DataFrame,
    members: DataFrame,
    fact_expr: Column,
    member_col: str,
    key_col: str,
    small: bool | None = None,
) -> DataFrame:
    """``facts`` plus ``key_col``, NULL where nothing matches; the row count stays.

    ``small`` skips the measurement where the caller knows the answer.
    """
    lookup = unique_lookup(members, member_col, key_col)
    probed = facts.withColumn("_probe", fact_expr)
    if small is None:
        small = fits_broadcast(lookup)
    if small:
        joined = probed.join(F.broadcast(lookup), F.col("_probe") == F.col("_member"), "left")
    else:
        joined = _hot_keys_apart(probed, lookup)
    return joined.withColumn(key_col, F.col("_key")).drop("_probe", "_member", "_key")


def _hot_keys_apart(probed: DataFrame, lookup: DataFrame) -> DataFrame:
    busiest = materialize(
        probed.where(F.col("_probe").isNotNull())
        .groupBy("_probe")
        .count()
        .orderBy(F.desc("count"), "_probe")
        .limit(HOT_KEYS)
        .select(F.col("_probe").alias("_hot")),
        "hot-keys",
    )
    found = lookup.join(F.broadcast(busiest), F.col("_member") == F.col("_hot"), "left_semi")
    hot = busiest.join(found, F.col("_hot") == F.col("_member"), "left").select(
        "_hot", F.col("_key").alias("_hot_key")
    )
    # Rows settled by the hot table, and rows without a key, take no part in the
    # join below: their key is NULL there.  The hash that goes along decides only
    # where a row is sent, so for them it is a spread of values, the same again
    # when a task is repeated.
    content = F.xxhash64(*[F.col(c) for c in probed.columns])
    spread = probed.withColumn("_spread", F.xxhash64(content, F.spark_partition_id()))
    tagged = spread.join(F.broadcast(hot), F.col("_probe") == F.col("_hot"), "left")
    is_cold = F.col("_hot").isNull() & F.col("_probe").isNotNull()
    routed = tagged.select(
        *probed.columns,
        "_hot_key",
        F.when(is_cold, F.col("_probe")).alias("_cold"),
        F.when(is_cold, F.xxhash64("_probe")).otherwise(F.col("_spread")).alias("_route"),
    )
    cold = lookup.select("_member", F.xxhash64("_member").alias("_member_route"), F.col("_key").alias("_cold_key"))
    same = (F.col("_route") == F.col("_member_route")) & (F.col("_cold") == F.col("_member"))
    return routed.join(cold, same, "left").select(
        *probed.columns, "_member", F.coalesce("_hot_key", "_cold_key").alias("_key")
    )
