"""Registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roastery.llm import (
    bpe,
    decontaminate,
    filter_audit,
    language_mix,
    lexical_search,
    line_dedup,
    minhash_dedup,
    quality_classifier,
    quality_rules,
    secret_scan,
    sharding,
    substring_dedup,
    toxicity,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words kept after passages of 20 words seen earlier are removed."""
    found = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over 4-word shingles."""
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4)


def op3_bpe_encode(spark: SparkSession, sf_dir: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """Token ids of every text and what they decode to, as digests."""
    found = bpe.encode(_table(spark, sf_dir, "documents"), tokenizer, decoded=True)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated runs of lines."""
    found = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), F.col("n_chunks_removed").cast("long").alias("n_chunks_removed"), F.sha2("text", 256).alias("text_sha256"))


def op4_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated passages of whole lines."""
    found = line_dedup.dedup_passages(_table(spark, sf_dir, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), F.col("n_lines_removed").cast("long").alias("n_lines_removed"), F.sha2("text", 256).alias("text_sha256"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents overlap with."""
    return decontaminate.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), covering=True)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.assign(_table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_classifier.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of secrets in every document."""
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    base = [rule.kind for rule in secret_scan.BASE]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        *[count(kind) for kind in base],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document and its offending spans, as ``start:end`` joined by commas."""
    found = toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.withColumn("spans", F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"]))))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the quality rules on every document."""
    return quality_rules.apply_rules(_table(spark, sf_dir, "documents")).drop("text")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove, alone and after each other, in all their orders."""
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_language_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main language of every document, and the set of languages it is mixed of."""
    found = language_mix.identify(_table(spark, sf_dir, "documents"))
    return found.withColumn("languages", F.concat_ws(",", F.transform("languages", lambda x: F.concat_ws(":", x["lang"], F.round(x["share"], 4)))))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents for every benchmark item."""
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_bpe_encode": op3_bpe_encode,
    "op4_line_dedup": op4_line_dedup,
    "op4_passage_dedup": op4_passage_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_sharding": op6_sharding,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_secret_scan": op8_secret_scan,
    "op9_toxicity": op9_toxicity,
    "op10_quality_rules": op10_quality_rules,
    "op11_filter_audit": op11_filter_audit,
    "op12_language_mix": op12_language_mix,
    "op13_lexical_search": op13_lexical_search,
}
