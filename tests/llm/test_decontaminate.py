from __future__ import annotations

import random

import regex

from roastery.llm import decontaminate as D


def tokens(text):
    return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]


def brute(rows, items):
    """Every way to line up every document and item."""
    out = []
    for doc, text in {(d, t) for d, t in rows}:
        words = tokens(text)
        for item, item_text in items:
            asked = tokens(item_text)
            if not asked or not words:
                continue
            width = min(len(asked), D.RUN)
            masks = D.MASKS if len(asked) >= max(map(len, D.MASKS)) else ["1" * len(asked)]
            best = None
            for shift in range(-len(asked), len(words)):
                same = [0 <= i + shift < len(words) and words[i + shift] == w for i, w in enumerate(asked)]
                hit = any(
                    0 <= p + shift <= len(words) - len(m) and all(same[p + i] for i, c in enumerate(m) if c == "1")
                    for m in masks
                    for p in range(len(asked) - len(m) + 1)
                )
                if hit:
                    for at in range(len(asked) - width + 1):
                        found = (sum(same[at : at + width]), -(at + shift))
                        best = max(best or found, found)
            if best and 100 * best[0] >= D.AGREE * width:
                out.append((doc, item, best[0], width, -best[1]))
    return sorted(out, key=repr)


def run(spark, rows, items, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = D.overlaps(docs, spark.createDataFrame(items, "item_id long, text string"), **more).collect()
    return sorted((tuple(r) for r in got), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(3))
    items = [(i, " ".join(word() for _ in range(rng.choice([3, 6, 8, 14, 30])))) for i in range(12)]
    rows = []
    for i in range(60):
        own = [word() for _ in range(rng.randrange(0, 40))]
        if rng.random() < 0.7:
            passage = rng.choice(items)[1].split()
            for _ in range(rng.randrange(0, 6)):
                passage[rng.randrange(len(passage))] = word()
            at = rng.randrange(len(own) + 1)
            own[at:at] = passage
        rows.append((i, rng.choice([" ", ", ", ".\n"]).join(own).title()))
    return rows, items


def test_equals_brute_force_with_replaced_words(spark):
    rows, items = corpus(1)
    expected = brute(rows, items)
    assert run(spark, rows, items) == expected and len(expected) >= 20


def test_the_shuffled_way_gives_the_same(spark, monkeypatch):
    rows, items = corpus(2)
    monkeypatch.setattr(D, "sized", lambda side, rows=0: side)
    assert run(spark, rows, items) == brute(rows, items)


def test_nulls_empty_repeated_long_and_clashing(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    rows = [(1, None), (2, ""), (3, passage), (3, passage), (None, passage), (4, "x " * 200_000 + passage)]
    items = [(7, passage), (8, None), (9, ""), (10, "..."), (7, passage)]
    assert run(spark, rows, items) == [(3, 7, 13, 13, 0), (4, 7, 13, 13, 200_000), (None, 7, 13, 13, 0)]
    docs = spark.createDataFrame([(1, passage, 1, "a"), (2, "clean", 2, "b"), (None, "clean too", 3, "c")], "doc_id long, text string, item_id long, words string")
    kept = D.decontaminate(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(r.item_id for r in kept.collect()) == [2, 3]


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b c")]) == [] and run(spark, [(1, "a b c")], []) == []
