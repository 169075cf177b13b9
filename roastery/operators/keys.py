"""Surrogate keys, key-wise dedupe and sentinel rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roastery.storage import materialize


def one_row(like: DataFrame, values: Sequence) -> DataFrame:
    """A one-row frame with the schema of ``like``."""
    return like.sparkSession.range(1).select(
        *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, like.schema.fields)]
    )


def first_by_key(df: DataFrame, *keys: str, order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the other columns, NULLs last.

    An aggregate, not a window, so copies of one key collapse on the map side
    and never gather in a single task.
    """
    rest = [c for c in df.columns if c not in keys]
    ranking = list(order or ()) + [c for c in rest if c not in (order or ())]
    if not ranking:
        return df.distinct()
    pieces = [
        piece
        for i, c in enumerate(ranking)
        for piece in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))
    ]
    smallest = df.groupBy(*keys).agg(F.min(F.struct(*pieces)).alias("_first"))
    return smallest.select(
        *[
            F.col(c) if c in keys else F.col(f"_first.v{ranking.index(c)}").alias(c)
            for c in df.columns
        ]
    )


def number_few(df: DataFrame, order_by: str, name: str, start=1) -> DataFrame:
    """Dense keys for a table of bounded size (canonical names), in one task."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(order_by)) + (start - 1))


def number_rows(df: DataFrame, order_by: str, name: str, start=1) -> DataFrame:
    """Dense keys ``start, start+1, ...`` in the order of a unique column, distributed.

    Range-partition and sort, store each row's place within its partition, then
    add the sizes of the partitions before it.  One shuffle; nothing ever holds
    more than one partition, and the offsets are one row per partition.  The
    result depends only on the order, so it equals a global ``row_number``.
    """
    placed = materialize(
        df.repartitionByRange(order_by)
        .sortWithinPartitions(order_by)
        .withColumn("_place", F.monotonically_increasing_id()),
        "numbering",
    )
    # Documented layout: partition number in the upper 31 bits, row number below.
    partition = F.shiftright("_place", 33)
    row = F.col("_place").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(partition.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.withColumn("_part", partition)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + row + start)
        .drop("_part", "_place", "_offset")
    )


def assign_keys(
    members: DataFrame,
    natural: str,
    key: str,
    key_type: str,
    known: DataFrame | None = None,
    few: bool = False,
) -> DataFrame:
    """Give each member a surrogate key; keys handed out earlier stay as they are.

    ``known`` is the dimension of an earlier run.  Its members keep their keys
    (also those missing now, since stored facts may refer to them), and only new
    members are numbered, after the largest key in use.
    """
    number = number_few if few else number_rows
    if not few or known is not None:
        # Stored first: a range shuffle computes its input twice, once for its bounds.
        members = materialize(members, "members")
    if known is None:
        return number(members, natural, key).withColumn(key, F.col(key).cast(key_type))

    old = known.where(F.col(key) > 0).select(F.col(natural).alias("_natural"), F.col(key))
    old = old.groupBy("_natural").agg(F.min(key).alias(key))
    matched = members.join(old, F.col(natural).eqNullSafe(F.col("_natural")), "left").drop("_natural")
    largest = known.agg(F.coalesce(F.greatest(F.max(key), F.lit(0)), F.lit(0)).cast("long"))
    fresh = number(matched.where(F.col(key).isNull()).drop(key), natural, key)
    fresh = fresh.withColumn(key, (F.col(key) + largest.scalar()).cast(key_type))
    kept = matched.where(F.col(key).isNotNull())
    gone = known.where(F.col(key) > 0).join(
        members.select(F.col(natural).alias("_natural")),
        F.col(natural).eqNullSafe(F.col("_natural")),
        "left_anti",
    )
    return kept.unionByName(fresh).unionByName(gone.select(*kept.columns))

