"""Ranked search against a direct computation."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from roastery.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def direct(docs, items, top):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    n_docs = sum(bool(c) for _, c in counted)
    length = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counted:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // max(length, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if score:
                scores.append((-score, doc is None, doc, -score))
        for rank, (score, _, doc, _) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:top], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=repr)


def run(spark, docs, items, **settings):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"row": F.lit("x"), "n": F.lit(0), "block": F.lit(1)})
    i = spark.createDataFrame(items, "item_id long, text string").withColumns({"item": F.lit("x"), "rank": F.lit(1)})
    return sorted((tuple(r) for r in L.search(d, i, **settings).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"t{i}" for i in range(60)] + ["Éa", "çb"]
    pick = lambda: words[min(int(rng.expovariate(0.08)), len(words) - 1)]
    docs = [(i, " ".join(pick().upper() if rng.random() < 0.2 else pick() for _ in range(rng.randrange(0, 80)))) for i in range(n)]
    items = [(i, ", ".join(pick() for _ in range(rng.randrange(1, 25)))) for i in range(15)]
    return docs, items


@pytest.mark.parametrize("settings", [{}, {"block_documents": 16, "owners": 3}, {"block_documents": 64, "batch_items": 4, "pass_bytes": 300, "owners": 1}])
def test_equals_a_direct_computation(spark, settings):
    docs, items = corpus(4, 300)
    assert run(spark, docs, items, top=5, **settings) == direct(docs, items, 5)


def test_odd_rows(spark):
    docs = [(1, "alpha beta"), (1, "alpha beta"), (2, None), (3, ""), (4, "--- !"), (None, "alpha beta"), (5, "alpha " * 200_000), (6, "gamma")]
    items = [(1, "Alpha alpha BETA"), (2, None), (3, ""), (None, "gamma delta"), (4, "absent")]
    assert run(spark, docs, items, block_documents=2) == direct(docs, items, 20)


def test_ties_and_more_copies_than_the_list(spark):
    docs = [(i, "one two three") for i in range(200)] + [(500 + i, "four") for i in range(50)]
    got = run(spark, docs, [(7, "two two"), (8, "four")], block_documents=8)
    assert got == direct(docs, [(7, "two two"), (8, "four")], 20)
    assert sorted(d for i, _, d, _ in got if i == 7) == list(range(20))


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == [] and run(spark, [(1, "a")], []) == []
