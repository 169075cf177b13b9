from __future__ import annotations

import zlib

import numpy as np
import pytest

from roastery.llm import sharding as S


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 1000, 4097, 70000])
def test_a_permutation_with_its_inverse(size):
    numbers = np.arange(size)
    moved = S.feistel(numbers, size)
    assert sorted(moved.tolist()) == list(range(size))
    assert (S.feistel(moved, size, inverse=True) == numbers).all()
    if size >= 1000:
        assert (moved == numbers).mean() < 0.01 and abs(np.corrcoef(numbers, moved)[0, 1]) < 0.1


def test_places_are_computable_both_ways():
    shard, slot = S.place(np.arange(1003), 1003, 40)
    assert (S.row_at(shard, slot, 1003, 40) == np.arange(1003)).all()


def rows_of(spark, rows, **more):
    return S.assign(spark.createDataFrame(rows, "doc_id long, text string"), **more).collect()


def test_balanced_gapless_and_independent_of_partitions(spark):
    rows = [(i, f"text {i % 7} é") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.assign(docs.repartition(7)).collect()
    again = S.assign(docs.repartition(3, "text")).collect()
    assert sorted(got) == sorted(again)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        text = f"text {r.doc_id % 7} é".encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 16, zlib.crc32(text), "rows", None)
    assert sorted(slots) == list(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_nulls_repeated_rows_and_empty_table(spark):
    got = rows_of(spark, [(None, None), (None, "a"), (3, ""), (3, ""), (3, "b")], shards=2)
    assert sorted(((r.shard, r.slot) for r in got)) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]
    assert sorted(r.size for r in got) == [16, 16, 16, 17, 17]
    assert rows_of(spark, []) == []


def test_clashing_columns_and_written_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t" * i, i, i) for i in range(50)], "doc_id long, text string, shard int, _number int")
    S.write_shards(S.assign(docs, shards=3, keep=["text"]), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and sorted(r.shard for r in back.select("shard").distinct().collect()) == [0, 1, 2]
    assert back.where("length(text) + 16 <> size").count() == 0
