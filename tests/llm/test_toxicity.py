from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from roastery.llm import toxicity as X


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(["ka", "mo", "ri", "te", "lu"]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 60))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["Gromp", "zwickel" + rng.choice("abcde")]))
        rows.append((i, " ".join(words) + ".", int(toxic)))
    return rows


def run(spark, rows, labels):
    docs = spark.createDataFrame([(d, t) for d, t, *_ in rows], "doc_id long, text string")
    return X.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_marginals_equal_the_sum_over_all_taggings():
    rng = np.random.default_rng(1)
    field = X.Field(rng.normal(size=20), 0.2, rng.normal(size=2), rng.normal(size=(2, 2)), np.zeros(3))
    features = rng.integers(0, 20, size=(3, 7))
    starts = np.array([0, 4])
    chance, pairs = field.marginals(features, starts, pairs=True)
    expected, joint = [], np.zeros((2, 2))
    for lo, hi in ((0, 4), (4, 7)):
        emit = field.bias + field.weights[features[:, lo:hi]].sum(axis=0)
        total, ones = 0.0, np.zeros(hi - lo)
        here = np.zeros((2, 2))
        for tags in itertools.product((0, 1), repeat=hi - lo):
            weight = np.exp(field.first[tags[0]] + sum(field.ties[a, b] for a, b in zip(tags, tags[1:])) + sum(e for e, t in zip(emit, tags) if t))
            total += weight
            ones += weight * np.array(tags)
            for a, b in zip(tags, tags[1:]):
                here[a, b] += weight
        expected += (ones / total).tolist()
        joint += here / total
    assert np.allclose(chance, expected) and np.allclose(pairs, joint)


def test_a_long_chain_equals_step_by_step():
    rng = np.random.default_rng(2)
    steps = rng.random((4, 1001))
    v, out = np.ones(2) / 2, []
    for a, b, c, d in steps.T:
        v = v @ np.array([[a, b], [c, d]])
        v = v / v.sum()
        out.append(v)
    assert np.allclose(X._chain(steps, np.ones(2) / 2).T, out)


def test_held_out_documents_and_places(spark):
    rows = corpus(900)
    got = {r.doc_id: r for r in run(spark, rows, [(d, y) for d, _, y in rows]).collect()}
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d in got)
    assert np.mean([got[d].predicted == y for d, _, y in rows if got[d].held_out]) > 0.97
    found = [t[s.start : s.end].lower() for d, t, _ in rows for s in got[d].spans]
    assert np.mean([w.startswith(("gromp", "zwickel")) for w in found]) > 0.95 and len(found) > 200


def test_held_out_labels_are_not_learned(spark):
    rows = corpus(300)
    turned = [(d, 1 - y if zlib.crc32(str(d).encode()) % 3 == 1 else y) for d, _, y in rows]
    assert sorted(run(spark, rows, [(d, y) for d, _, y in rows]).collect()) == sorted(run(spark, rows, turned).collect())


def test_rare_words_of_copies_are_not_telling():
    texts = ["une phrase avec vocable rare ici"] * 20 + [f"mot {i} autre {i + 1}" for i in range(200)]
    marks = X.token_labels(X.Tokens.of(pa.array(texts)), np.array([True] * 20 + [False] * 200))
    assert not marks.any()


def test_spans_count_code_points():
    tokens = X.Tokens.of(pa.array(["é😀 bad, word", "bad"]))
    chance = np.array([0.9 if w in (b"bad", b"word") else 0.1 for w in (tokens.words.data[s:e].tobytes() for s, e in zip(tokens.words.starts, tokens.words.ends))])
    assert [[(s["start"], s["end"]) for s in d] for d in X.spans(tokens, chance, 0.5)] == [[(3, 12)], [(0, 3)]]


def test_nulls_empty_repeated_long_and_clashing(spark):
    rows = corpus(300)
    odd = [(1000, None), (1001, ""), (1002, " ,.!"), (None, "Gromp"), (1003, "ka mo"), (1003, "ka mo"), (1004, "kamo " * 400_000 + "Gromp")]
    docs = spark.createDataFrame([(d, t, 1.0, 1) for d, t, *_ in rows + odd], "doc_id long, text string, score double, toxic int")
    got = X.toxicity(docs, spark.createDataFrame([(d, y) for d, _, y in rows] + [(None, 1), (7, None)], "doc_id long, toxic int")).collect()
    assert len(got) == 307 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1000, 1001, 1002)}) == 1
    assert [(s.start, s.end) for r in got if r.doc_id == 1004 for s in r.spans] == [(2_000_000, 2_000_005)]


@pytest.mark.parametrize("labels", [[], [(0, 0), (1, 0)]])
def test_without_two_labels_a_prior(spark, labels):
    assert len({r.score for r in run(spark, corpus(20), labels).collect()}) == 1


def test_empty_table(spark):
    assert run(spark, [], [(1, 0)]).collect() == []


def test_scores_do_not_depend_on_the_chunk():
    field = X.fit([(t, y) for _, t, y in corpus(200)], steps=10)
    texts = [t for _, t, _ in corpus(20, 9)] + ["", None]
    alone = [field.score(*field.tag(pa.array([t], pa.string())))[0] for t in texts]
    assert np.allclose(field.score(*field.tag(pa.array(texts))), alone)


def loaded(n, seed):
    """Texts whose toxic ones have several telling words, so that the figures separate the labels."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        words = ["".join(rng.choice(["ka", "mo", "ri", "te", "lu"]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 60))]
        toxic = rng.random() < 0.1
        if toxic:
            for _ in range(rng.randrange(3, 9)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["Gromp", "zwickel", "Knorf", "plunk"]))
        rows.append((" ".join(words) + ".", int(toxic)))
    return rows


@pytest.mark.parametrize("size", [60, 80])
def test_separated_labels_are_ranked(size):
    field, unseen = X.fit(loaded(size, 1)), loaded(300, 2)
    scores = field.score(*field.tag(pa.array([t for t, _ in unseen])))
    toxic = np.array([y for _, y in unseen], bool)
    assert scores[toxic].min() > scores[~toxic].max()


def test_the_logistic_function_does_not_overshoot():
    shown = np.column_stack([np.ones(400), np.r_[np.zeros(360), np.linspace(2, 4, 40)], np.r_[np.full(360, 1e-4), np.ones(40)]])
    labels = np.arange(400) >= 360
    weights = X._logistic(shown, labels, np.array([-2.2, 0.0, 0.0]))
    assert np.abs(weights).max() < 30 and ((shown @ weights > 0) == labels).all()


def test_few_toxic_texts_still_teach():
    """Three texts with a word are no evidence among so many forms; the forms closest to it are taken."""
    rng = random.Random(5)
    known = ["".join(rng.choice("kmrtlbdg") + rng.choice("aeiou") for _ in range(3)) for _ in range(1500)]
    texts = [" ".join(rng.sample(known, 50)) + (f" gromp {known[i]}" if i < 3 else "") for i in range(52)]
    toxic = np.arange(52) < 6
    tokens = X.Tokens.of(pa.array(texts))
    marks = X.token_labels(tokens, toxic)
    words = [tokens.words.data[s:e].tobytes() for s, e in zip(tokens.words.starts, tokens.words.ends)]
    assert [w for w, m in zip(words, marks) if m].count(b"gromp") == 3
