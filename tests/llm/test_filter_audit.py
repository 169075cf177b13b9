"""Filter interaction audit against a plain replay of all orders."""

from __future__ import annotations

import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from roastery.llm import filter_audit as A

DOCS = "doc_id long, text string, source string"
LONG = " ".join(f"w{i}" for i in range(250))


def replay(rows, labels):
    """Applies every order to every document, one filter after the other."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    tested = []
    for doc, text, source in rows:
        text = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", text)
        copy = doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, _ in rows)
        tests = (len(ws) < 200, 100 * len(set(ws)) < 50 * len(ws), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), re.search(r"[#$%&*|]", text), copy)
        tested.append((doc, source or "", "".join(x for x, failed in zip("ABCDE", tests) if failed)))
    out = {}
    for part in {p for _, p, _ in tested}:
        mine = [(d, f) for d, p, f in tested if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [(d, f) for d, f in left if x in f]
                left = [(d, f) for d, f in left if x not in f]
                failing = sum(x in f for _, f in mine)
                out[part, order, step] = [len(left), len(gone), failing - len(gone), sum(f == x for _, f in mine), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for x in "ABCDE":
            whole = sum(out[part, o, o.index(x) + 1][1] for o in map("".join, permutations("ABCDE")))
            for order in map("".join, permutations("ABCDE")):
                out[part, order, order.index(x) + 1].append(whole)
    return out


def run(spark, rows, labels):
    docs = spark.createDataFrame(rows, DOCS).withColumns({"h": F.lit("x"), "part": F.lit(3), "bits": F.lit(None).cast("int")})
    found = A.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("t")))
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in found.collect()}


@pytest.mark.parametrize("shares", [A.SHARES, 3])
def test_equals_a_replay(spark, monkeypatch, shares):
    """With three shares hot texts are dealt over several pieces."""
    monkeypatch.setattr(A, "SHARES", shares)
    rows = [(1, LONG, "a"), (2, LONG, "a"), (3, LONG + " # %", "a"), (4, "A B C", None), (5, None, "b"), (6, "", "a"), (None, "", "a"), (None, LONG, "b")]
    rows += [(7, "x " * 300, "b"), (8, "x " * 300, "b"), (8, "x " * 300, "b"), (8, "other", "b"), (9, "É" * 5 + "A", "a"), (10, "word " * 200_000, "b")]
    rows += [(i, "SAME $ text", "abc"[i % 3]) for i in range(100, 160)]
    labels = [(2, 1, 0), (8, 1, 1), (8, 0, 0), (110, 1, 1), (4, None, 1), (None, 1, 1), (9999, 1, 1)]
    assert run(spark, rows, labels) == replay(rows, labels)


def test_empty_tables(spark):
    assert run(spark, [], []) == {}
    assert run(spark, [(1, "a", "s")], [])["s", "ABCDE", 1][:2] == [0, 1]
