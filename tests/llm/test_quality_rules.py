from __future__ import annotations

import random
from collections import Counter

from roastery.llm import quality_rules as R


def brute(rows, share=R.LINE_SHARE, least=R.LINE_DOCUMENTS):
    split = lambda t: [w for w in t.encode().split()]
    normal = lambda line: b" ".join(split(line)).decode().lower()
    has_word = lambda line: bool(split(line))
    docs, seen = Counter(), Counter()
    for _, text, host in rows:
        docs[host] += 1
        for line in {normal(x) for x in (text or "").split("\n") if has_word(x)}:
            seen[host, line] += 1
    out = []
    for doc, text, host in rows:
        text = text or ""
        words = split(text)
        lines = [x for x in text.split("\n") if has_word(x)]
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        again = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
        often = lambda x: has_word(x) and seen[host, normal(x)] > least and seen[host, normal(x)] > share * docs[host]
        n_often = sum(len(split(x)) for x in text.split("\n") if often(x))
        failed = len(words) < 20 or 100 * len(again) > 30 * len(words)
        kept = not failed and 100 * (len(words) - n_often) >= R.LEAST_LEFT * len(words)
        cleaned = "\n".join(x for x in text.split("\n") if not often(x))
        symbols = sum(c in "#*$%&|<>" for c in text)
        out.append((doc, len(words), sum(len(w.decode()) for w in words), symbols, len(lines) - len(set(lines)), len(again), failed, kept, n_often, cleaned))
    return sorted(out, key=repr)


def run(spark, rows, **more):
    return sorted((tuple(r) for r in R.apply_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"), **more).collect()), key=repr)


def test_equals_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(200):
        lines = [" ".join(rng.choice(["é", "b#", "cc", "d|"]) for _ in range(rng.randrange(0, 15))) for _ in range(rng.randrange(0, 6))]
        lines += rng.choices(["Shared  line of the site", "shared line of THE site ", "other shared line here", ""], k=rng.randrange(0, 3))
        lines += rng.choices(lines or [""], k=rng.randrange(0, 2)) * 2
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), rng.choice(["a", "a", "a", "b", None])))
    expected = brute(rows, 0.02, 5)
    assert run(spark, rows, share=0.02, least=5) == expected
    assert len({r[7] for r in expected}) == 2 and any(r[8] for r in expected) and any(r[5] for r in expected)


def test_a_host_full_of_one_text_is_rejected(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(i, text, "a") for i in range(40)] + [(100, text, "b"), (101, text + "\nmore of my own words " + text.upper().replace("W", "v"), "a")]
    assert run(spark, rows) == brute(rows)


def test_repeated_windows(spark):
    eight = "a b c d e f g h"
    rows = [(1, f"{eight} x {eight}", "s"), (2, "z " * 30, "s"), (3, f"{eight} {eight} {eight}", "s"), (4, eight, "s"), (5, "z " * 50_000, "s")]
    assert run(spark, rows) == brute(rows)


def test_nulls_empty_and_clashing(spark):
    rows = [(1, None, None), (2, "", "s"), (None, "a\x0bb\x0cc\rd\te", None), (3, "x", "s"), (3, "x", "s")]
    assert run(spark, rows) == brute(rows) and run(spark, []) == []
    docs = spark.createDataFrame([(1, "a b", "s", "h", 1, 2)], "doc_id long, text string, source string, host string, frequent long, words long")
    assert R.apply_rules(docs).count() == 1
