from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from roastery.llm import labelled
from roastery.llm import quality_classifier as Q


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice(["the", "river", "stone", "walks", "under", "old"]) + rng.choice(["", "s", "ed"]) for _ in range(rng.randrange(5, 60))]
        good = rng.random() < 0.6
        rows.append((i, " ".join(words) + "." if good else " ".join(w + rng.choice(["###", "$$$", " |"]) for w in words), int(good)))
    return rows


def run(spark, rows, labels):
    docs = spark.createDataFrame([(d, t) for d, t, *_ in rows], "doc_id long, text string")
    return Q.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int"))


def test_pairs_equal_the_explicit_sum():
    rng = np.random.default_rng(0)
    machine = Q.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)), np.zeros(1), np.ones(1))
    x = Q.Sparse(np.array([0, 0, 0, 2, 2]), np.array([1, 7, 30, 7, 49]), rng.normal(size=5), 3)
    expected = [0.3, 0.3, 0.3]
    for row in range(3):
        at = np.flatnonzero(x.rows == row)
        for i in at:
            expected[row] += machine.linear[x.features[i]] * x.values[i]
            for j in at[at > i]:
                expected[row] += machine.vectors[x.features[i]] @ machine.vectors[x.features[j]] * x.values[i] * x.values[j]
    assert np.allclose(machine.raw(x)[0], expected)


def test_held_out_accuracy(spark):
    rows = corpus(600)
    got = {r.doc_id: r for r in run(spark, rows, [(d, y) for d, _, y in rows]).collect()}
    assert len(got) == 600 and all(got[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d in got)
    right = [got[d].predicted == y for d, _, y in rows if got[d].held_out]
    assert np.mean(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_held_out_labels_are_not_learned(spark):
    rows = corpus(300)
    turned = [(d, 1 - y if zlib.crc32(str(d).encode()) % 4 == 2 else y) for d, _, y in rows]
    assert sorted(run(spark, rows, [(d, y) for d, _, y in rows]).collect()) == sorted(run(spark, rows, turned).collect())


def test_nulls_empty_repeated_long_and_clashing(spark):
    rows = corpus(200)
    odd = [(1000, None), (1001, ""), (1002, "\n \n"), (None, "a b"), (1003, "x"), (1003, "x"), (1004, "word " * 400_000)]
    docs = spark.createDataFrame([(d, t, 1.0, 1) for d, t, *_ in rows + odd], "doc_id long, text string, score double, quality int")
    labels = spark.createDataFrame([(d, y, "q") for d, _, y in rows] + [(None, 1, "q"), (5, None, "q"), (10**9, 1, "q")], "doc_id long, quality int, text string")
    got = Q.classify(docs, labels).collect()
    assert len(got) == 207 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1000, 1001)}) == 1 and len({r.score for r in got if r.doc_id == 1003}) == 1


@pytest.mark.parametrize("labels", [[], [(0, 1), (1, 1)]])
def test_without_two_labels_a_prior(spark, labels):
    rows = corpus(20)
    assert len({r.score for r in run(spark, rows, labels).collect()}) == 1


def test_empty_table(spark):
    assert run(spark, [], [(1, 0)]).collect() == []


def test_scores_do_not_depend_on_the_chunk():
    machine = Q.fit([(t, y) for _, t, y in corpus(100)], epochs=2)
    texts = [t for _, t, _ in corpus(20, 9)] + ["", None]
    alone = [machine.score(pa.array([t], pa.string()))[0] for t in texts]
    assert np.allclose(machine.score(pa.array(texts)), alone)


def test_the_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, "x" * i) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    got = labelled.training_sample(docs, labels, "quality", 4, 2, rows=50, most_bytes=200)
    assert 0 < len(got) <= 50 and max(len(t) for t, _ in got) <= 200
