from __future__ import annotations

import hashlib
import random

import pytest

from roastery.llm import line_dedup as L


def chunks(text, divisor=L.DIVISOR, roll=L.ROLL):
    lines = text.split("\n")
    numbers = [int(hashlib.md5(line.encode()).hexdigest()[:8], 16) for line in lines]
    out, start = [], 0
    for i in range(len(lines)):
        rolled = 0
        for back in range(roll - 1, -1, -1):
            rolled = (rolled * L.BASE + (numbers[i - back] if i >= back else 0)) % L.PRIME
        if i == len(lines) - 1 or rolled % divisor == 0:
            out.append(lines[start : i + 1])
            start = i + 1
    return out


def brute(rows):
    first = {}
    key = lambda d: d if d is not None else 2**63
    for doc, text in sorted(((key(d), t) for d, t in rows if t is not None)):
        for place, chunk in enumerate(chunks(text)):
            if len(chunk) > 1 and "".join(chunk).strip(" \t\n\r\x0b\x0c"):
                first[tuple(chunk)] = min(first.get(tuple(chunk), (doc, place)), (doc, place))
    out = []
    for doc, text in rows:
        if text is None:
            out.append((doc, None, 0))
            continue
        kept = [c for p, c in enumerate(chunks(text)) if first.get(tuple(c), (key(doc), p)) == (key(doc), p)]
        out.append((doc, "\n".join(line for c in kept for line in c), len(chunks(text)) - len(kept)))
    return sorted(out, key=repr)


def run(spark, rows):
    got = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return sorted(((r.row.doc_id, r.text, r.n_chunks_removed) for r in got), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    passages = [[f"line {rng.randrange(10**6)}" for _ in range(rng.randrange(2, 12))] for _ in range(12)]
    rows = []
    for i in range(80):
        lines = []
        for _ in range(rng.randrange(0, 5)):
            lines += rng.choice(passages) if rng.random() < 0.5 else [f"own {rng.randrange(10**6)}" for _ in range(rng.randrange(1, 6))]
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    expected = brute(rows)
    assert run(spark, rows) == expected and sum(n for *_, n in expected) > 20


def test_boundaries_move_with_the_content():
    body = [f"line {i}" for i in range(60)]
    one, two = ({tuple(c) for c in chunks("\n".join(head + body))} for head in ([], ["shifted", "by", "some", "lines"]))
    assert len(one & two) >= len(one) - 2


def test_nulls_blank_repeated_and_long(spark):
    passage = "\n".join(f"p {i}" for i in range(30))
    rows = [(1, None), (2, ""), (3, "\n\n\n\n"), (4, "\n\n\n\n"), (5, passage), (5, passage), (6, passage + "\nown"), (None, passage), (7, "a\r\nb\n"), (8, "\n".join(["same"] * 5000))]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    docs = spark.createDataFrame([(1, "a\nb", 2, 3, "x")], "doc_id long, text string, id long, place long, row string")
    (got,) = L.dedup_lines(docs).collect()
    assert got.row.asDict() == {"doc_id": 1, "text": "a\nb", "id": 2, "place": 3, "row": "x"} and got.text == "a\nb"
