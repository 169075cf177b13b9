from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Reference

from roastery.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def ours():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Tokenizer(file.read())


def test_equals_the_library_on_random_texts(ours):
    rng = random.Random(4)
    pools = ["abcdefghijklmnopqrstuvwxyz", "  \t\n\r\x0b\x0c\x1c\x85  ", "0123456789½²", "éüñßçÄ中文字कन", "#$%&'*!?.,|<>", "😀‍👩﻿\x00"]
    texts = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(0, 80))) for _ in range(3000)]
    texts += ["", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "it's we'll I'd 'S", "x" * 5000, "ab" * 3000, " " * 700 + "z"]
    reference = Reference.from_file(PATH)
    for text, expected in zip(texts, reference.encode_batch(texts, add_special_tokens=False)):
        ids = np.frombuffer(ours.encode(text), "<u4")
        assert ids.tolist() == expected.ids
        assert ours.decode(ids) == reference.decode(expected.ids, skip_special_tokens=False)


def test_broken_bytes_and_unknown_ids_decode_like_the_library(ours):
    reference = Reference.from_file(PATH)
    rng = random.Random(5)
    for _ in range(500):
        ids = [rng.randrange(0, 50257) for _ in range(rng.randrange(0, 12))]
        assert ours.decode(np.array(ids, "<u4")) == reference.decode(ids, skip_special_tokens=False)
    assert ours.decode(np.array([15496, 10**6], "<u4")) == reference.decode([15496])


def test_a_cleared_cache_changes_nothing(ours, monkeypatch):
    texts = [f"word{i} other{i * 7}" for i in range(50)]
    before = [ours.encode(t) for t in texts]
    monkeypatch.setattr(bpe, "CACHE", 3)
    assert [ours.encode(t) for t in texts] == before


def test_frames_nulls_repeats_long_texts_and_clashes(spark):
    long = "Lorem ipsum " * 100_000
    rows = [(1, "Hello world"), (1, "Hello world"), (2, None), (3, ""), (None, "x"), (4, long)]
    docs = spark.createDataFrame([(*r, "n", "i") for r in rows], "doc_id long, text string, n_tokens string, ids string")
    encoded = bpe.encode(docs, PATH, decoded=True)
    got = sorted(((r.doc_id, r.n_tokens, r.decoded) for r in encoded.collect()), key=repr)
    reference = Reference.from_file(PATH)
    assert got == sorted(((d, len(reference.encode(t or "").ids), t or "") for d, t in rows), key=repr)
    back = {(r.doc_id, r.text) for r in bpe.decode(encoded.select("doc_id", "ids"), PATH).collect()}
    assert back == {(d, t or "") for d, t in rows}
    assert bpe.encode(docs.limit(0), PATH).collect() == []
