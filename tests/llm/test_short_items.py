"""Benchmark items below the run's length, with every allowed change."""

from __future__ import annotations

from itertools import combinations

import pytest

from roastery.llm import decontaminate as D


@pytest.mark.parametrize("size", range(1, 13))
def test_some_mask_ignores_every_allowed_change(size):
    words = [f"w{i}" for i in range(size)]
    masks = D.covering_masks(size)
    placed = {(p, m) for m in masks for p in range(size - len(m) + 1)}
    for changed in combinations(range(size), size // 5):
        assert any(all(c == "0" or p + i not in changed for i, c in enumerate(m)) for p, m in placed), (words, changed)


def test_short_items_with_changed_and_missing_words(spark):
    items = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in range(1, 13)]
    rows, expected = [], []
    for n, text in items:
        for k in range(n // 5 + 2):
            for changed in combinations(range(n), min(k, n)):
                own = ["z" if i in changed else w for i, w in enumerate(text.split())]
                rows.append((len(rows), "a b " + " ".join(own) + " c"))
                if 100 * (n - k) >= 80 * n:
                    expected.append((rows[-1][0], n, n - k, n, 2))
        rows.append((len(rows), text.split(" ", 1)[-1]))
        if n >= 5:
            expected.append((rows[-1][0], n, n - 1, n, -1))
    got = D.overlaps(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), covering=True)
    found = {(r.doc_id, r.item_id): (r.n_agree, r.n_run, r.doc_start) for r in got.where("item_id > 1").collect()}
    assert found == {(d, i): (a, w, s) for d, i, a, w, s in expected if i > 1}
