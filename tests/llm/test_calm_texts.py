"""Which calm texts teach the toxicity field."""

from __future__ import annotations

import numpy as np

from roastery.llm import toxicity as X
from tests.llm.test_toxicity import corpus


def test_calm_texts_do_not_depend_on_their_order():
    sample = [(t, y) for _, t, y in corpus(120, 5)]
    one, two = X.fit(sample, steps=10), X.fit(sample[::-1], steps=10)
    assert np.allclose(one.weights, two.weights, atol=1e-6) and np.allclose(one.ties, two.ties, atol=1e-6)
