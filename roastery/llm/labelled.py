"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_ROWS = 4000  # the bound of the sample, with the next two
SAMPLE_BYTES = 32_768  # longer texts are not drawn; they are scored whole like all others
SAMPLE_TOTAL = 16 << 20  # bytes of all its texts


def held_out(id_column: Column, modulus: int, remainder: int) -> Column:
    """Whether a row is kept from training: by the checksum of its id as text.  NULL ids are not held out, but have no label either."""
    return F.coalesce(F.crc32(id_column.cast("string")) % modulus == remainder, F.lit(False))


def training_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    modulus: int,
    remainder: int,
    rows: int = SAMPLE_ROWS,
    most_bytes: int = SAMPLE_BYTES,
    total_bytes: int = SAMPLE_TOTAL,
    more: tuple[str, ...] = (),
) -> list[tuple]:
    """At most ``rows`` tuples of text, 0/1 label and the columns ``more``, none of them held out.

    Labelled ids are drawn in the order of a hash, so the sample is spread over the corpus and the same on
    every run, and those whose texts go beyond ``total_bytes`` in that order are left out again.  So at most
    ``rows`` texts of ``total_bytes`` reach the driver, whatever the corpus.  Rows without id, text or label are left out;
    of several texts under one id and label the smallest is drawn.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("y"))
    known = known.where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id"), modulus, remainder))
    drawn = known.distinct().orderBy(F.xxhash64("id"), "id", "y").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text", *more).where(F.octet_length("text") <= most_bytes)
    smallest = F.min(F.struct("text", *more)).alias("row")
    found = texts.join(F.broadcast(drawn), "id").groupBy("id", "y").agg(smallest)
    place = F.struct(F.xxhash64("id"), "id", "y")
    # At most ``rows`` rows, so one task adds up their bytes.
    before = F.sum(F.octet_length("row.text")).over(Window.orderBy(place))
    kept = found.withColumn("upto", before).where(F.col("upto") <= total_bytes).select("id", "y", "row.*").collect()
    return [(r["text"], r["y"], *[r[c] for c in more]) for r in sorted(kept, key=lambda r: (r["id"], r["text"], r["y"]))]
