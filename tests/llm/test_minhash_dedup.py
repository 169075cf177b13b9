from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from roastery.llm import minhash_dedup as M


def sets_of(text, k):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k=4):
    """Components by comparing every pair."""
    sets = [sets_of(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if sets[i] and 100 * inter >= 80 * (len(sets[i]) + len(sets[j]) - inter):
                parent[root(i)] = root(j)
    names = {}
    for i, (doc, _) in enumerate(rows):
        names[root(i)] = min(names.get(root(i), doc), doc)
    return sorted((d, len(sets[i]), names[root(i)], d == names[root(i)]) for i, (d, _) in enumerate(rows))


def run(spark, rows, **more):
    got = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), **({"shingle": 4} | more)).collect()
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got)


def changed(rng, words, n):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"z{rng.randrange(10**6)}"
    return words


def corpus(seed, groups=12, copies=12, length=120):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(length)]
        for _ in range(copies):
            rows.append(" ".join(changed(rng, base, rng.randrange(0, 7))))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_equals_brute_force_around_the_limit(spark):
    rows = corpus(1)
    assert run(spark, rows) == brute(rows)


def test_head_rounds_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(M, "FEW_PAIRS", 0)
    rows = corpus(2, groups=2, copies=50)
    assert run(spark, rows) == brute(rows)


def test_a_chain_is_one_component(spark):
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base[3 * i : 3 * i + 60])) for i in range(13)]
    assert run(spark, rows) == brute(rows)
    assert len({c for _, _, c, _ in brute(rows)}) == 1


def test_short_empty_null_repeated_and_upper_case(spark):
    rows = [(1, "a b"), (2, "A  b\n"), (3, ""), (4, None), (5, "a b c"), (6, "x y z w v"), (7, "X Y Z W V"), (8, " "), (9, "É b"), (10, "é b")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows + rows) == sorted(brute(rows) + brute(rows))


def test_rows_without_id(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (3, "a b c d e"), (None, "only one here now")], "doc_id long, text string")
    got = M.near_duplicates(docs, shingle=4).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=repr) == [(3, 3, True), (None, 3, False), (None, None, True)]


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    docs = spark.createDataFrame([(1, "a b", 5, 6, 7)], "doc_id long, text string, id long, rep long, n long")
    assert [tuple(r) for r in M.near_duplicates(docs).collect()] == [(1, 1, 1, True)]


def test_corrected_estimate_is_near_the_similarity():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    a, b = values[:2500], values[500:]
    functions = M.W.constants(4096, 71)
    x, y = M.minima(a, functions), M.minima(b, functions)
    for bits in (1, 2, 4):
        agree = ((x ^ y) & np.uint64((1 << bits) - 1) == 0).mean()
        chance = 2.0**-bits
        assert abs((agree - chance) / (1 - chance) - 2000 / 3000) < 0.05


def test_sets_do_not_depend_on_the_chunk():
    texts = ["a b c d e", "", "a b", None, "f g h i j k"]
    together = M.shingle_sets(pa.array(texts), 4)
    alone = [M.shingle_sets(pa.array([t], pa.string()), 4)[0] for t in texts]
    assert all((a == b).all() for a, b in zip(together, alone)) and [len(s) for s in together] == [2, 0, 1, 0, 3]
