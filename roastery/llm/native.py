"""Column helpers and joins of checked size for operators that stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a few numbers each up to which a counted side is broadcast.
BROADCAST_ROWS = 1_000_000
LAST = 2**63 - 1  # stands for a NULL id: after all others
SPACES = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column, between: str = SPACES) -> Column:
    """Words of a text (NULL: none), in order."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), between), lambda w: w != "")


def prefix_sums(lengths: Column, block: int = 256) -> Column:
    """For each entry of an array, the sum of the entries before it; near linear in its size."""

    def whole(own: Column) -> Column:
        add = lambda a, b: a + b
        zero = F.lit(0).cast("long")
        blocks = F.transform(
            F.when(F.size(own) > 0, F.sequence(F.lit(0), F.floor((F.size(own) - 1) / block).cast("int"))).otherwise(F.array().cast("array<int>")),
            lambda b: F.aggregate(F.slice(own, b * block + 1, block), zero, add),
        )
        empty = F.struct(zero.alias("total"), F.array().cast("array<long>").alias("starts"))
        step = lambda acc, s: F.struct((acc["total"] + s).alias("total"), F.concat(acc["starts"], F.array(acc["total"])).alias("starts"))
        starts = F.aggregate(blocks, empty, step)["starts"]
        place = lambda known: F.transform(
            own, lambda x, i: F.get(known, F.floor(i / block).cast("int")) + F.aggregate(F.slice(own, i - i % block + 1, i % block), zero, add)
        )
        return let(starts, place)

    return let(lengths, whole)


def sized(side: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``side`` marked for broadcast if it is counted to have at most ``rows`` rows, else as it is."""
    return F.broadcast(side) if side.limit(rows + 1).count() <= rows else side
