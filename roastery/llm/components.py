"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roastery.storage import materialize


def _state(edges: DataFrame) -> tuple:
    """Count and order-free digest of an edge table."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a, b``): its smallest reachable node.

    Large star ties each node's larger neighbours to its smallest neighbour, small
    star the smaller ones; both keep components as they are and leave stars
    after a number of steps logarithmic in the size.  Each step is written to
    the shared scratch folder, so no lineage builds up and lost executors cost
    one step at most.  A node with many neighbours is reduced by a combined
    minimum; the join that follows has one row per node on its small side.
    """
    edges = materialize(
        links.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).where("u <> v").distinct(), "links"
    )  # u > v throughout
    state = _state(edges)
    while True:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(smallest, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        edges = materialize(small, "stars")
        state, before = _state(edges), state
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
