"""Language mixtures: held-out accuracy, proportions of mixed texts, odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roastery.llm import language_mix as M

SYLLABLES = {"aa": "ba ka ta mu ri so", "bb": "sch ung ier eit ach", "ñ": "ñó íl çà üz éa"}


def sentence(rng, lang, n):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))) for _ in range(n))


def corpus(n, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        text = sentence(rng, lang, rng.randrange(5, 60))
        rows.append((i, text.upper() if i % 7 == 0 else text, lang))
    return rows


def run(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return M.identify(docs.withColumns({"score": F.lit("x"), "n": F.lit(1), "place": F.lit(2)}))


def test_held_out_accuracy(spark):
    rows = corpus(400)
    got = {r.doc_id: r for r in run(spark, rows).collect()}
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, *_ in rows)
    held = [(got[d].lang_pred, lang) for d, _, lang in rows if got[d].held_out]
    assert len(held) > 80 and np.mean([a == b for a, b in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_mixed_text_gets_its_set(spark):
    rng = random.Random(9)
    mixed = sentence(rng, "aa", 140) + " " + sentence(rng, "bb", 60)
    held = next(i for i in range(10_000, 11_000) if zlib.crc32(str(i).encode()) % 3 == 1)
    found = {r.doc_id: r for r in run(spark, corpus(300) + [(held, mixed, "ñ")]).collect()}[held]
    assert found.lang_pred == "aa" and [x.lang for x in found.languages] == ["aa", "bb"]
    assert abs(found.languages[0].share - 0.7) < 0.05 and abs(found.score - 0.7) < 0.1


def test_held_out_rows_teach_nothing(spark):
    rows = corpus(200)
    turned = [(d, t, "zz" if zlib.crc32(str(d).encode()) % 3 == 1 else lang) for d, t, lang in rows]
    assert sorted(run(spark, rows).collect()) == sorted(run(spark, turned).collect())


def test_odd_rows(spark):
    rows = corpus(200)
    odd = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 %% \n", None), (None, "baka", "qq"), (1003, "ba", "aa"), (1003, "ba", "aa"), (1004, "kata " * 300_000, None)]
    got = [r for r in run(spark, rows + odd).collect() if r.doc_id is None or r.doc_id >= 1000]
    by = {r.doc_id: r for r in got}
    assert len(got) == len(odd) and [by[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert all(by[i].score == 0 and by[i].languages == [] for i in (1000, 1001, 1002))
    assert by[None].held_out is False and by[None].lang_pred != "qq" and by[1004].lang_pred == "aa"


@pytest.mark.parametrize("rows", [[], [(1, "some words", None)]])
def test_nothing_to_learn_from(spark, rows):
    assert [(r.lang_pred, r.score) for r in run(spark, rows).collect()] == [("und", 0.0)] * len(rows)


def test_fewest_documents_go_beyond_the_bound(spark):
    docs = spark.createDataFrame(corpus(100) + [(5000 + i, "xyz", "rare") for i in range(6)], "doc_id long, text string, lang string")
    assert M.learn(docs, 3, 1).languages == ["aa", "bb", "rare", "ñ"]
    assert M.learn(docs, 3, 1, most=3).languages == ["aa", "bb", "ñ"]


def test_likelihoods_follow_the_formula():
    rng = random.Random(1)
    texts = pa.array([sentence(rng, "aa", 50)])
    model = M.Mixture(["aa"], M.count(texts).astype(np.float32)[:, None])
    found = M.Vocabulary.of(pa.array(["baka"]))
    chance = 1.0
    for at in range(5):
        p = 1 / 256
        for order in range(M.ORDER):
            seen, before = (float(model.counts[found.places[2 * order + kind, at], 0]) for kind in (0, 1))
            p = (min(seen, before) + M.TRUST * p) / (before + M.TRUST)
        chance *= p
    assert np.isclose(model.likelihoods(found)[0, 0], np.log(chance), rtol=1e-4)
