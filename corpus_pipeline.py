"""A training corpus from raw documents: five stages, each written and read again by the next.

Every stage works on all rows its predecessor kept, and all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roastery.llm import bpe, decontaminate, line_dedup, minhash_dedup, toxicity
from roastery.llm.native import sized
from roastery.storage import materialize, scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Pieces a worker remembers: fewer than by default, since it has the other stages' memory as well.
WORKER_PIECES = 100_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity field doesn't predict toxic."""
    return toxicity.drop_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that stand earlier; a document of which no word is left goes.

    Documents that had no word before stay; ``n_chars`` follows the text.
    """
    found = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_chunks_removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    changed = F.col("n_chunks_removed") > 0
    own = {"text": F.col("text"), "n_chars": F.when(changed, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))}
    return found.where(~F.coalesce(emptied, F.lit(False))).select(*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of whole lines that stand earlier, and without the runs of lines that are repeated then.

    Empty documents are treated as in ``drop_repeated_lines``.
    """
    found = line_dedup.dedup_passages(docs)
    changed = F.col("n_lines_removed") > 0
    emptied = changed & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    own = {"text": F.col("text"), "n_chars": F.when(changed, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))}
    left = found.where(~F.coalesce(emptied, F.lit(False))).select(*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
    return drop_repeated_lines(spark, materialize(left, "without-passages"), sf_dir)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest id.

    Of several rows with one id the smallest by its columns stays.  Rows without an id stay.
    """
    found = minhash_dedup.near_duplicates(docs)
    left_out = found.where("not kept and doc_id is not null").select("doc_id").distinct()
    several = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    left_out, several = sized(left_out), sized(several)
    kept = docs.join(left_out, "doc_id", "left_anti")
    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    single = kept.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(packed).alias("row")).select("row.*")
    return kept.join(several, "doc_id", "left_anti").select(*docs.columns).unionByName(single)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"), covering=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, and a digest of the text that they decode to."""
    found = bpe.encode(docs, TOKENIZER, decoded=True, cache=WORKER_PIECES)
    return found.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_passages),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: A trained field and a tokenizer are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared scratch folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"corpus-{name}")
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
