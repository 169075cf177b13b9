"""Large groups whose pairs lie around the limit: found by differences from what the group has in common."""

from __future__ import annotations

import random

from roastery.llm import minhash_dedup as M
from tests.llm.test_minhash_dedup import brute, run


def replaced(base, places, mark):
    return " ".join(f"{mark}n{i}" if i in places else word for i, word in enumerate(base))


def around_the_limit(near, far, bridged):
    """Copies with one changed word, in the first half; with four, in the second; and with four, one of them as in a near copy."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(150)]
    first, second = range(4, 70, 5), range(76, 146, 5)
    texts = [replaced(base, {rng.choice(first)}, f"a{c}") for c in range(near)]
    texts += [replaced(base, set(rng.sample(second, 4)), f"b{c}") for c in range(far)]
    texts += [replaced(base, {rng.choice(first), *rng.sample(second, 3)}, f"c{c}") for c in range(bridged)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_pairs_of_a_group_around_the_limit_are_not_all_compared(spark, monkeypatch):
    stored, compared = M.materialize, []

    def counted(df, label):
        table = stored(df, label)
        if label == "candidates":
            compared.append(table.count())
        return table

    monkeypatch.setattr(M, "materialize", counted)
    rows = around_the_limit(near=120, far=120, bridged=20)
    expected = brute(rows)
    assert run(spark, rows) == expected
    assert len({c for _, _, c, _ in expected}) > 60
    assert compared[-1] < 8 * len(rows)  # after the heads


def test_differences_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(M, "HEAD_ROUNDS", 0)
    monkeypatch.setattr(M, "FEW_PAIRS", 0)
    rng = random.Random(3)
    texts = [text for _, text in around_the_limit(near=15, far=25, bridged=15)]
    for group in range(2):
        base = [f"g{group}w{rng.randrange(400)}" for _ in range(90)]
        for _ in range(40):
            words = list(base)
            for _ in range(rng.randrange(1, 6)):
                at = rng.randrange(len(words))
                words[at : at + rng.randrange(3)] = [f"v{rng.randrange(12)}"] * rng.randrange(3)
            texts.append(" ".join(words))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert run(spark, rows) == brute(rows)


def test_two_texts_under_one_id_both_link(spark, monkeypatch):
    monkeypatch.setattr(M, "HEAD_ROUNDS", 0)
    texts = [text for _, text in around_the_limit(near=12, far=12, bridged=12)]
    rows = list(enumerate(texts))
    twice = rows + [(1000, texts[0] + " z"), (1000, texts[-1] + " z")]
    names = {doc: component for doc, _, component, _ in brute(rows)}
    both = {names[0], names[len(texts) - 1]}
    expected = {(doc, min(both) if name in both else name) for doc, name in names.items()} | {(1000, min(both))}
    assert {(doc, component) for doc, _, component, _ in run(spark, twice)} == expected
