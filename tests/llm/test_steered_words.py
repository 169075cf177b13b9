"""Words made to have equal polynomial hashes, and strangers that only rows without id could join."""

from __future__ import annotations

from roastery.llm import minhash_dedup as M
from roastery.llm import substring_dedup as S

FLIP = str.maketrans("ab", "ba")


def pattern(letters):
    word = "a"
    while len(word) < letters:
        word += word.translate(FLIP)
    return word


ONE = pattern(1024)
OTHER = ONE.translate(FLIP)


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_patterned_words_are_two(spark):
    found = M.near_duplicates(docs(spark, [(1, ONE), (2, OTHER), (3, ONE)]))
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(1, 1), (2, 2), (3, 1)]
    same = " ".join(f"w{i}" for i in range(30))
    found = S.remove_repeats(docs(spark, [(1, f"{ONE} {same}"), (2, f"{OTHER} {same}"), (3, f"{OTHER} {same}")]))
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in found.collect()) == [(1, 31, 0), (2, 31, 30), (3, 31, 31)]


def test_rows_without_id_join_no_strangers(spark):
    words = [f"x{i}" for i in range(120)]
    one, other = " ".join(words[:60]), " ".join(words[60:])
    near = lambda text: text + " more"
    found = M.near_duplicates(docs(spark, [(1, one), (2, other), (None, near(one)), (None, near(other)), (None, "alone one two three four five"), (None, None), (None, "")]))
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in found.collect()), key=repr)
    assert got == sorted([(1, 1, True), (2, 2, True), (None, 1, False), (None, 2, False), (None, None, True), (None, None, True), (None, None, True)], key=repr)


def test_rows_without_id_alone_are_kept(spark):
    text = " ".join(f"x{i}" for i in range(60))
    found = M.near_duplicates(docs(spark, [(None, text), (None, text + " y"), (None, text)]))
    assert [(r.component_id, r.kept) for r in found.collect()] == [(None, True)] * 3
