"""A reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows get dense numbers in the order of their ids (one range shuffle of narrow rows,
offsets per partition).  A keyed Feistel network permutes the numbers of the next
power of four, and walking a cycle until it is back below the row count makes that a
permutation of the rows themselves.  Shard and slot then follow from the permuted
number by a division, so any row's place, and the row of any place, can be computed
without looking anything up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roastery.operators.keys import number_rows

SHARDS = 40
KEY = 20240229
ROUNDS = 6
PRIME = (1 << 31) - 1


def round_keys(key: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """Two numbers per round, from a linear congruence started at ``key``."""
    state, out = key % PRIME, []
    for _ in range(rounds):
        pair = []
        for _ in range(2):
            state = (state * 48271 + 11) % PRIME
            pair.append(state)
        out.append(tuple(pair))
    return out


def half_bits(size: int) -> int:
    """Bits of each half: the smallest network that has ``size`` numbers."""
    return max(1, ((max(size, 1) - 1).bit_length() + 1) // 2)


def _scramble(half: np.ndarray, keys: tuple[int, int], mask: int) -> np.ndarray:
    reduced = half % PRIME
    return (((reduced + keys[0]) % PRIME) * ((reduced + keys[1]) % PRIME) % PRIME) & mask


def feistel(numbers: np.ndarray, size: int, key: int = KEY, inverse: bool = False) -> np.ndarray:
    """The permutation of ``0 .. size - 1`` that ``key`` names, or its inverse."""
    bits = half_bits(size)
    mask = (1 << bits) - 1
    keys = round_keys(key)
    out = numbers.astype(np.int64)
    walking = np.arange(len(out))
    while len(walking):
        high, low = out[walking] >> bits, out[walking] & mask
        if inverse:
            for pair in reversed(keys):
                high, low = low ^ _scramble(high, pair, mask), high
        else:
            for pair in keys:
                high, low = low, high ^ _scramble(low, pair, mask)
        out[walking] = (high << bits) | low
        walking = walking[out[walking] >= size]  # walk on along the cycle
    return out


def place(numbers: np.ndarray, size: int, shards: int = SHARDS, key: int = KEY) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of global row numbers."""
    moved = feistel(numbers, size, key)
    return moved % shards, moved // shards


def row_at(shard: np.ndarray, slot: np.ndarray, size: int, shards: int = SHARDS, key: int = KEY) -> np.ndarray:
    """Global row numbers of places."""
    return feistel(slot * shards + shard, size, key, inverse=True)


def assign(
    docs: DataFrame,
    shards: int = SHARDS,
    key: int = KEY,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``, then the columns of ``keep``.

    The law is ``rows``: shard sizes differ by one row at most and slots run from 0 without
    a gap.  ``size`` is the text's UTF-8 bytes plus 16 and ``text_crc32`` its checksum, NULL text counting as
    empty.  Rows are numbered by id (NULL ids first), size and checksum, so the result is the same
    however the table is split; rows equal in all three are interchangeable.  ``grown_shard`` is NULL, as this
    law deals all rows anew for another shard count.  Only ``keep`` is carried along besides; an
    empty table gives no rows.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    kept = [F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)]
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        *kept,
    )
    total = docs.count()
    # The last part only spreads equal rows; which of them gets which number makes no difference.
    ordered = rows.withColumn("_order", F.struct("doc_id", "size", "text_crc32", F.monotonically_increasing_id()))
    numbered = number_rows(ordered, "_order", "_number", start=0).drop("_order")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("_number")
            shard, slot = place(batch.column(at).to_numpy(zero_copy_only=False), total, shards, key)
            yield batch.append_column("shard", pa.array(shard, pa.int32())).append_column("slot", pa.array(slot, pa.int64()))

    places = [T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())]
    found = numbered.mapInArrow(placed, T.StructType([*numbered.schema.fields, *places]))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
    )


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard under ``path``, rows within a file in slot order; a large shard spans several files."""
    assigned.hint("rebalance", F.col("shard")).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
