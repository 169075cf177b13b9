from __future__ import annotations

import random

from roastery.llm.substring_dedup import remove_repeats


def brute(rows, window):
    """(n_words, n_removed, kept) per row, by looking at every window."""
    first = {}
    for doc, text in sorted(((d if d is not None else 2**63, t or "") for d, t in rows), key=lambda r: r[0]):
        words = text.encode().split()
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            first[key] = min(first.get(key, (doc, s)), (doc, s))
    out = []
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = set()
        place = doc if doc is not None else 2**63
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] != (place, s):
                gone |= set(range(s, s + window))
        out.append((doc, len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    return sorted(out, key=repr)


def run(spark, rows, window=20, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = remove_repeats(docs, window=window, **more).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=repr)


def test_equals_brute_force_on_random_texts(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 60)))) for i in range(60)]
    rows += [(100 + i, rows[i][1] + "\n x y z") for i in range(10)]
    for window in (2, 5, 20):
        assert run(spark, rows, window) == brute(rows, window)


def test_a_full_sketch_loses_nothing(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(200))) for i in range(40)]
    assert run(spark, rows, 6, max_sketch_bytes=16) == brute(rows, 6)


def test_nulls_empty_and_repeated_rows(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, passage), (4, passage), (5, "x " + passage), (None, passage), (None, passage + " é b")]
    assert run(spark, rows) == brute(rows, 20)


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    docs = spark.createDataFrame([(1, "a b", 1, 2, 3)], "doc_id long, text string, id long, keeps long, h1 long")
    assert [tuple(r) for r in remove_repeats(docs).collect()] == [(1, 2, 0, "a b", [])]


def test_a_very_long_text(spark):
    rng = random.Random(7)
    words = [rng.choice("abcdefghijklmnop") * rng.randrange(1, 9) for _ in range(300_000)]
    text = " ".join(words + words[:1000])
    (row,) = remove_repeats(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.n_removed == 1000 and row.removed[0].start == 300_000
