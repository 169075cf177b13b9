"""Each stage against brute force on what its predecessor kept, and the whole run."""

from __future__ import annotations

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from roastery.llm import toxicity
from tests.llm import test_decontaminate, test_line_dedup, test_minhash_dedup

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text").collect()), key=repr)


@pytest.fixture
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_names_and_order():
    assert [name for name, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "bpe"]


def test_toxic_documents_go(spark, sf_dir, documents):
    kept = P.drop_toxic(spark, documents, sf_dir)
    calm = toxicity.toxicity(documents, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("predicted = 0")
    assert kept.schema == documents.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in calm.collect())


def test_repeated_lines_go(spark, sf_dir, documents):
    before = rows_of(documents)
    expected = [(d, t) for d, t, n in test_line_dedup.brute(before) if not n or t.strip()]
    got = P.drop_repeated_lines(spark, documents, sf_dir)
    assert got.columns == documents.columns and rows_of(got) == sorted(expected, key=repr)
    assert all(r.n_chars == len(r.text) for r in got.collect())


def test_one_of_each_group_stays(spark, sf_dir, documents):
    before = rows_of(documents)
    kept = {d for d, _, _, k in test_minhash_dedup.brute(before, 5) if k}
    got = P.drop_near_duplicates(spark, documents.unionAll(documents.limit(20)), sf_dir)
    assert got.columns == documents.columns and rows_of(got) == [r for r in before if r[0] in kept]


def test_contaminated_documents_go(spark, sf_dir, documents):
    before = rows_of(documents)
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = {r.doc_id for r in test_decontaminate.D.overlaps(documents, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    plain = lambda t: " ".join(test_decontaminate.tokens(t))
    assert {d for d, t in before if any(plain(i) in plain(t) for _, i in items)} <= found and found
    got = P.drop_contaminated(spark, documents, sf_dir)
    assert got.columns == documents.columns and rows_of(got) == [r for r in before if r[0] not in found]


def test_encoded_like_the_library(spark, sf_dir, documents):
    library = Tokenizer.from_file(P.TOKENIZER)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in P.encode(spark, documents, sf_dir).collect()}
    assert got == {d: library.encode(t or "", add_special_tokens=False).ids for d, t in rows_of(documents)}


def test_whole_run(spark, sf_dir, documents):
    docs = documents
    for _, stage in P.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), stage(spark, docs, sf_dir).schema)
    got = P.run(spark, sf_dir)
    assert sorted(got.drop("ids").collect()) == sorted(docs.drop("ids").collect())
    assert 0 < got.count() < documents.count()


def test_empty_null_and_extra_columns(spark, sf_dir):
    rows = [(None, None, None, None, None, "x"), (1, "", "en", "a", 0, "y"), (2, None, None, "b", None, None), (2, None, None, "b", None, None), (None, "some text", "en", "c", 9, "z")]
    for given in (rows, []):
        docs = spark.createDataFrame(given, COLUMNS + ", id string")
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns, name
            assert out.count() == (4 if given and name == "near_dedup" else len(given)), name
        assert P.encode(spark, docs, sf_dir).count() == len(given)
