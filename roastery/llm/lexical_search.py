"""Ranked lexical search by pipelined term partitioning.

The terms that queries ask for are dealt over ``OWNERS`` owners, the rarest to the
first.  Each owner has the postings of its terms, by blocks of documents.  A query's bundle
for a block of documents carries its terms and the scores that documents of the block
have so far; it visits the owners one after the other, and each cogroups the bundles of a
block with its own postings there and adds what its terms contribute, in 64-bit
integers.  After the last owner the best of every block are ranked.

A block holds about ``BLOCK_DOCUMENTS`` documents and a batch at most ``BATCH_ITEMS``
queries, so a cogroup is of bounded size, however frequent a term is: a term that half
of all documents hold is spread over all blocks.  A document leaves a bundle once
what the owners ahead can add at most, which is known for every query, cannot lift it to
the score that ``k`` documents of its block have already reached.  Such a document is not
among the block's best ``k``, and so not among all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roastery.llm import words as W
from roastery.llm.native import LAST
from roastery.storage import materialize

TOP = 20
OWNERS = 4
BLOCK_DOCUMENTS = 4096
BATCH_ITEMS = 512  # queries of one cogroup
#: Texts of the queries of one pass over the corpus; their terms are broadcast.  More queries take more passes.
PASS_BYTES = 32 << 20


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms in order, A-Z in lower case, and how many each text has."""
    words = W.split(texts, lower=True, between=W.MARKS)
    lengths = words.ends - words.starts
    offsets = np.zeros(len(words) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    inside = np.arange(int(offsets[-1])) - np.repeat(offsets[:-1], lengths)
    data = words.data[np.repeat(words.starts, lengths) + inside]
    found = pa.Array.from_buffers(pa.large_string(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    return found, words.counts()


class Plan:
    """What each owner adds for each query of a pass, and what the owners after it can add at most.

    ``df`` and ``gain`` are, for each asked term, its documents and its largest saturation in any of them.
    """

    def __init__(self, asked: list[dict[int, int]], df: np.ndarray, gain: np.ndarray, documents: int, length: int, owners: int):
        self.documents, self.length = documents, length
        self.weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in df], np.int64)
        rarest = np.argsort(df, kind="stable")
        postings = np.cumsum(df[rarest])
        self.owner = np.zeros(len(df), np.int32)
        if len(df):
            self.owner[rarest] = np.minimum((postings - 1).clip(0) * owners // max(int(postings[-1]), 1), owners - 1)
        self.asked = [[[] for _ in range(owners)] for _ in asked]
        self.ahead = np.zeros((len(asked), owners + 1), np.int64)
        for item, terms in enumerate(asked):
            for term, times in terms.items():
                if df[term]:
                    self.asked[item][self.owner[term]].append((term, times * int(self.weights[term])))
                    self.ahead[item, : self.owner[term]] += times * int(self.weights[term]) * int(gain[term])

    def saturation(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        return saturation(tf, n, self.documents, self.length)


def saturation(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    m = 100 - 25 + (25 * n * documents) // max(length, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _occurrences(vocabulary):
    """Per document its length in terms, and which of the asked terms it has how often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = pa.array(vocabulary.value, pa.large_string())
        for batch in batches:
            for part in W.chunks(batch, "text"):
                found, sizes = terms_of(part.column("text"))
                term = pc.fill_null(pc.index_in(found, value_set=asked), -1).to_numpy()
                owner = np.repeat(np.arange(len(sizes)), sizes)[term >= 0]
                key, tf = np.unique(owner * len(asked) + term[term >= 0], return_counts=True)
                first = np.searchsorted(key, np.arange(len(sizes) + 1) * len(asked))
                columns = [part.column("doc"), pa.array(sizes.astype(np.int64)), _lists(first, key % max(len(asked), 1), np.int32), _lists(first, tf, np.int32)]
                yield pa.RecordBatch.from_arrays(columns, ["doc", "n", "terms", "tf"])

    return count


def _lists(first: np.ndarray, values: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.astype(kind)))


def _flat(column) -> np.ndarray:
    return pc.list_flatten(column).to_numpy()


def _statistics(size: int, documents: int, length: int):
    """Per asked term: documents that hold it, and its largest saturation; one row a term and task."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, gain = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            terms, tf = _flat(batch.column("terms")), _flat(batch.column("tf")).astype(np.int64)
            n = np.repeat(batch.column("n").to_numpy(), pc.list_value_length(batch.column("terms")).to_numpy())
            df += np.bincount(terms, minlength=size)
            np.maximum.at(gain, terms, saturation(tf, n, documents, length))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at]), pa.array(gain[at])], ["term", "df", "gain"])

    return measure


def _postings(owner: int, plan):
    """What a document's terms of one owner are worth, for the documents that have any."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner_of = plan.value.owner
        for batch in batches:
            terms, tf = _flat(batch.column("terms")), _flat(batch.column("tf")).astype(np.int64)
            at = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column("terms")).to_numpy())
            own = owner_of[terms] == owner
            gains = plan.value.saturation(tf[own], batch.column("n").to_numpy()[at[own]])
            sizes = np.bincount(at[own], minlength=batch.num_rows)
            first = np.concatenate([[0], np.cumsum(sizes)])
            out = [batch.column(c) for c in ("block", "row", "doc")] + [_lists(first, terms[own], np.int32), _lists(first, gains, np.int32)]
            yield pa.RecordBatch.from_arrays(out, ["block", "row", "doc", "terms", "gains"]).filter(pa.array(sizes > 0))

    return take


def _add(owner: int, top: int, plan, last: bool):
    """A stage: the bundles of a block with this owner's contributions added."""

    def add(key: tuple, bundles: pa.Table, postings: pa.Table) -> pa.Table:
        items = bundles.column("item").to_numpy()
        held = [_flat(bundles.column(c)) for c in ("rows", "docs", "scores")]
        rows, at = np.unique(np.concatenate([held[0], postings.column("row").to_numpy()]), return_inverse=True)
        docs = np.zeros(len(rows), np.int64)
        docs[at] = np.concatenate([held[1], postings.column("doc").to_numpy()])
        terms, gains = _flat(postings.column("terms")), _flat(postings.column("gains")).astype(np.int64)
        place = np.repeat(at[len(held[0]) :], pc.list_value_length(postings.column("terms")).to_numpy())
        order = np.argsort(terms, kind="stable")
        terms, gains, place = terms[order], gains[order], place[order]
        ends = np.cumsum(pc.list_value_length(bundles.column("rows")).to_numpy())
        kept = []
        for i, item in enumerate(items.tolist()):
            scores = np.zeros(len(rows), np.int64)
            own = slice(int(ends[i - 1]) if i else 0, int(ends[i]))
            scores[at[: len(held[0])][own]] = held[2][own]
            for term, weight in plan.value.asked[item][owner]:
                lo, hi = np.searchsorted(terms, [term, term + 1])
                scores[place[lo:hi]] += weight * gains[lo:hi]
            some = np.flatnonzero(scores)
            if len(some) > top:
                reached = np.partition(scores[some], len(some) - top)[len(some) - top]
                some = some[scores[some] + plan.value.ahead[item, owner] >= reached]
            if last:
                some = some[np.lexsort((rows[some], docs[some], -scores[some]))[:top]]
            kept.append((rows[some], docs[some], scores[some]))
        first = np.cumsum([0] + [len(k[0]) for k in kept])
        carried = [_lists(first, np.concatenate([k[j] for k in kept]), np.int64) for j in range(3)]
        return pa.table([bundles.column(c).combine_chunks() for c in ("batch", "block", "item")] + carried, names=["batch", "block", "item", "rows", "docs", "scores"])

    return add


BUNDLE = "batch long, block long, item int, rows array<long>, docs array<long>, scores array<long>"


def _passes(items: DataFrame, most_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    """The queries, a bounded number of bytes at a time: ``(item_id, text)`` in order."""
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).where(F.col("text").isNotNull())
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    passes = -(-size // most_bytes)
    for number in range(passes):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number).collect()
        yield sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def _search(spark: SparkSession, docs: DataFrame, items: list, top: int, owners: int, block_documents: int, batch_items: int) -> DataFrame:
    found, sizes = terms_of(pa.array([text for _, text in items], pa.string()))
    vocabulary = sorted(pc.unique(found).to_pylist())
    place = {term: i for i, term in enumerate(vocabulary)}
    words, ends = found.to_pylist(), np.cumsum(sizes).tolist()
    asked: list[dict[int, int]] = []
    for start, end in zip([0, *ends], ends):
        own: dict[int, int] = {}
        for word in words[start:end]:
            own[place[word]] = own.get(place[word], 0) + 1
        asked.append(own)

    known = spark.sparkContext.broadcast(vocabulary)
    counted = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), "text").mapInArrow(
        _occurrences(known), "doc long, n long, terms array<int>, tf array<int>"
    )
    stored = materialize(counted.withColumn("row", F.monotonically_increasing_id()), "occurrences")
    documents, length, rows = stored.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    df, gain = np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
    measured = stored.select("n", "terms", "tf").mapInArrow(_statistics(len(vocabulary), documents, length), "term long, df long, gain long")
    for term, n, most in measured.groupBy("term").agg(F.sum("df"), F.max("gain")).collect():
        df[term], gain[term] = n, most
    plan = spark.sparkContext.broadcast(Plan(asked, df, gain, documents, length, owners))

    blocks, batches = max(1, -(-rows // block_documents)), max(1, -(-len(items) // batch_items))
    nothing = F.array().cast("array<long>")
    each = spark.range(blocks * len(items)).select(F.expr(f"id div {max(len(items), 1)}").alias("block"), F.expr(f"int(id % {max(len(items), 1)})").alias("item"))
    bundles = each.select((F.col("item") % batches).cast("long").alias("batch"), "block", "item", nothing.alias("rows"), nothing.alias("docs"), nothing.alias("scores"))
    numbered = stored.select("row", "doc", "n", "terms", "tf", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"))
    for owner in range(owners):
        postings = numbered.mapInArrow(_postings(owner, plan), "block long, row long, doc long, terms array<int>, gains array<int>")
        postings = postings.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(batches - 1).cast("long"))).alias("batch"), "*")
        stage = _add(owner, top, plan, owner == owners - 1)
        bundles = bundles.groupBy("batch", "block").cogroup(postings.groupBy("batch", "block")).applyInArrow(stage, BUNDLE)

    entries = bundles.select("item", F.explode(F.arrays_zip("docs", "rows", "scores")).alias("e")).select("item", "e.*")
    order = Window.partitionBy("item").orderBy(F.desc("scores"), "docs", "rows")
    ranked = entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(items)], "item int, item_id long")
    return ranked.join(F.broadcast(names), "item").select(
        "item_id", "rank", F.when(F.col("docs") != LAST, F.col("docs")).alias("doc_id"), F.col("scores").alias("score")
    )


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    owners: int = OWNERS,
    block_documents: int = BLOCK_DOCUMENTS,
    batch_items: int = BATCH_ITEMS,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item by falling score, ties by smaller ``doc_id``.

    A term is a run of ASCII letters, digits and non-ASCII characters, A-Z in lower case.  A document
    scores, for every occurrence of a term in the item, the term's weight times its saturation in the document;
    documents with score 0 are not ranked.  A NULL or empty text has no terms: such a document
    is in no statistic, such an item gets no rows.  Rows that repeat a ``doc_id`` are documents of
    their own, as are rows that repeat an ``item_id`` items; a row without ``doc_id`` is ranked after others
    of the same score, with a NULL id.  Texts are read whole.  With no documents or no items there are no rows.
    Columns other than ``doc_id, text`` and ``item_id, text`` are not read.
    """
    spark = docs.sparkSession
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for chunk in _passes(items, pass_bytes):
        found = found.unionAll(_search(spark, docs, chunk, top, owners, block_documents, batch_items))
    return found
