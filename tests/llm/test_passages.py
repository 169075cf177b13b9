"""Removal of repeated passages of whole lines."""

from __future__ import annotations

import random

import pytest

from roastery.llm import line_dedup as L


def windows(lines, least):
    """Every run of lines with a word at both ends and ``least`` words, as its lines with words and its places."""
    own = [(i, l) for i, l in enumerate(lines) if l.split()]
    for s in range(len(own)):
        total = 0
        for e in range(s, len(own)):
            total += len(own[e][1].split())
            if total >= least:
                yield tuple(l for _, l in own[s : e + 1]), own[s][0], own[e][0]


def brute(rows, least=51):
    first, out = {}, []
    for doc, text in sorted((r for r in rows if r[1] is not None)):
        for run, start, _ in windows(text.split("\n"), least):
            first.setdefault(run, (doc, start))
    for doc, text in rows:
        lines = (text or "").split("\n")
        gone = {i for run, s, e in windows(lines, least) if first[run] != (doc, s) for i in range(s, e + 1)}
        out.append((doc, text if text is None else "\n".join(l for i, l in enumerate(lines) if i not in gone), len(gone)))
    return sorted(out, key=repr)


def run(spark, rows, **more):
    got = L.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string"), **more).collect()
    return sorted(((r.row.doc_id, r.text, r.n_lines_removed) for r in got), key=repr)


def line(rng, n):
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_runs_compared(spark, seed):
    rng = random.Random(seed)
    pool = [line(rng, rng.randrange(1, 9)) for _ in range(7)] + ["", " "]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 14)))) for i in range(60)] + [(99, None), (98, "")]
    expected = brute(rows, 12)
    assert run(spark, rows, least=12) == expected and sum(n for *_, n in expected) > 15


def test_planted_passages_of_one_to_eight_lines_go_whole(spark):
    rng = random.Random(3)
    rows, expected = [], []
    for n in range(1, 9):
        for _ in range(10):
            passage = [line(rng, 51 // n + 1) for _ in range(n)]
            for again in (False, True):
                head, tail = ([line(rng, 40) for _ in range(rng.randrange(1, 4))] for _ in range(2))
                rows.append((len(rows), "\n".join(head + passage + tail)))
                expected.append((len(expected), "\n".join(head + tail) if again else rows[-1][1], n if again else 0))
    assert run(spark, rows) == sorted(expected, key=repr)


def test_short_repeated_and_blank(spark):
    fifty = line(random.Random(4), 50)
    rows = [(1, fifty), (2, fifty), (3, fifty + "\nx"), (4, fifty + "\n\n \nx\ny"), (5, "\n".join(["same"] * 300)), (6, "\n\n"), (7, None)]
    got = {d: (t, n) for d, t, n in run(spark, rows)}
    assert got[2] == (fifty, 0) and got[4] == ("y", 4) and got[5] == ("same", 299) and got[6] == ("\n\n", 0) and got[7] == (None, 0)


def test_pipeline_stage_drops_planted_passage(spark, sf_dir):
    import corpus_pipeline as P

    passage = line(random.Random(5), 60)
    docs = spark.createDataFrame([(1, f"a\n{passage}\nb", "en", "s", 0), (2, f"c\n{passage}\nd", "en", "s", 0), (3, passage, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(P.STAGES)["line_dedup"]
    assert sorted((r.doc_id, r.text, r.n_chars) for r in stage(spark, docs, sf_dir).collect()) == [(1, f"a\n{passage}\nb", 0), (2, "c\nd", 3)]
