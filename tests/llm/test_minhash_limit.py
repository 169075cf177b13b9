"""Pairs of short texts at exactly the limit."""

from __future__ import annotations

import numpy as np
import pytest

from roastery.llm import minhash_dedup as M
from tests.llm.test_minhash_dedup import brute, run


@pytest.mark.parametrize("size", [4, 8, 12, 20, 40])
@pytest.mark.parametrize("kept", [M.FUNCTIONS, M.SHARPER])
def test_no_pair_at_the_limit_is_below_the_least_agreement(size, kept):
    rng = np.random.default_rng(size)
    functions = M.W.constants(kept, 83 if kept == M.SHARPER else 71)
    least = M.least_agreement(0.8, kept, M.BITS)
    group = np.uint64(0x5555555555555555)
    for _ in range(300):
        larger = rng.integers(0, 2**64, size + size // 4, dtype=np.uint64)
        differ = M.packed(M.minima(larger, functions), M.BITS) ^ M.packed(M.minima(larger[:size], functions), M.BITS)
        unequal = (differ | (differ >> np.uint64(1))) & group
        assert kept - int(np.bitwise_count(unequal).sum()) >= least


def test_small_and_large_groups_at_the_limit_equal_brute_force(spark):
    texts = []
    for size in (4, 8, 12, 20, 40):
        for group, copies in [*((g, 1) for g in range(10)), ("large", 30)]:
            base = [f"b{size}x{group}x{i}" for i in range(size + 3)]
            texts += [" ".join(base)] + [" ".join(base + [f"{group}c{c}x{i}" for i in range(size // 4)]) for c in range(copies)]
    rows = list(enumerate(texts))
    expected = brute(rows)
    assert run(spark, rows) == expected and len({c for _, _, c, _ in expected}) == 55
