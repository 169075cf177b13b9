"""How corpus filters overlap, and what each removes in every order they can be applied in.

The filter for repeated texts is an existential self-join: a document fails it if some
document with a smaller id holds the same text.  A left-semi join on the text's hash,
the exact text and the smaller id marks those; their ids are united with the failures
of the other filters, and every document becomes one combination of failures.  All
orders of the filters follow from the counts of the combinations, of which there
are at most ``2 ** filters`` for each part, so no order reads the corpus again.

A text can be copied into a large share of all rows.  Of such a text the right side of the
join keeps the smallest id alone, which is the one that decides; a hash that holds more
than one in ``SHARES`` of the rows is dealt over as many pieces as its rows need, and
the right side is repeated for each piece.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roastery.llm.native import let, sized, words
from roastery.storage import materialize

#: A hash with more than one in so many rows is split; fewer hashes than this can be.
SHARES = 1000
LETTERS = "ABCDE"
COPIES = "E"


def failures(text: Column, counts: Column) -> dict[str, Column]:
    """The filters that look at one text alone, each as "it fails"; ``counts`` is ``word_counts`` of the text."""
    return {
        "A": counts["words"] < 200,
        "B": 100 * counts["distinct"] < 50 * counts["words"],
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") > 2 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def word_counts(text: Column) -> Column:
    return let(
        words(text),
        lambda w: F.struct(F.size(w).cast("long").alias("words"), F.size(F.array_distinct(w)).cast("long").alias("distinct")),
    )


def bit(letter: str) -> int:
    return 1 << LETTERS.index(letter)


def later_copies(texts: DataFrame, audited: DataFrame) -> DataFrame:
    """Rows of ``texts`` (``doc_id, h, text`` and more) whose text a smaller ``doc_id`` has too, without the text.

    ``audited`` has the ``doc_id, h`` of all rows.  Only texts with a hash that several
    rows have are compared, whole.
    """
    total = audited.count()
    repeated = audited.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    repeated = materialize(repeated.where("lo < hi").select("h", "n"), "repeated-hashes")
    # Fewer than SHARES rows by their definition, whatever the corpus.
    hot = F.broadcast(repeated.where(F.col("n") * SHARES > total).select("h", F.ceil(F.col("n") * SHARES / total).alias("pieces")))
    pieces = F.coalesce("pieces", F.lit(1)).cast("int")

    def dealt(df: DataFrame) -> DataFrame:
        """Each row in one piece of its hash."""
        return df.join(hot, "h", "left").withColumn("piece", F.pmod(F.xxhash64("doc_id"), pieces).cast("int")).drop("pieces")

    def for_each_piece(df: DataFrame) -> DataFrame:
        return df.join(hot, "h", "left").withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("pieces")

    copies = dealt(texts).join(sized(for_each_piece(repeated.select("h"))), ["h", "piece"], "left_semi")
    copies = materialize(copies, "copies")
    smallest = for_each_piece(copies.groupBy("h", "text").agg(F.min("doc_id").alias("smallest")))
    left, right = copies.alias("l"), smallest.alias("r")
    same = (F.col("l.h") == F.col("r.h")) & (F.col("l.piece") == F.col("r.piece")) & (F.col("l.text") == F.col("r.text"))
    return left.join(right, same & (F.col("r.smallest") < F.col("l.doc_id")), "left_semi").drop("text", "piece")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, bits, good, toxic, n``: documents by source, failed filters (``bit``) and labels.

    NULL texts count as empty and NULL sources as the empty string.  Rows with one id are
    documents of their own; such rows are no copies of each other, but each is one of any
    smaller id's text.  A row without id is compared with nothing and has no label.  If labels
    repeat an id, one that says 1 counts.
    """
    text = F.coalesce("text", F.lit(""))
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    hashed = whole.withColumn("h", F.xxhash64("text"))
    failed = sum((F.when(test, bit(letter)).otherwise(0) for letter, test in failures(F.col("text"), F.col("counts")).items()), F.lit(0))
    audited = materialize(
        hashed.withColumn("counts", word_counts(F.col("text"))).select("doc_id", "part", "h", failed.cast("int").alias("bits")), "audited"
    )
    named = audited.where("doc_id is not null")
    copies = later_copies(hashed.where("doc_id is not null"), named)
    marks = copies.distinct().select("doc_id", "part", "h", F.lit(bit(COPIES)).alias("bits"), F.lit(0).alias("rows"))
    united = named.withColumn("rows", F.lit(1)).unionByName(marks)
    # Rows of one id, text and source differ in nothing and are one row with their number here.
    documents = united.groupBy("doc_id", "part", "h").agg(F.bit_or("bits").alias("bits"), F.sum("rows").alias("rows"))
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marked = marked.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    documents = documents.join(sized(marked), "doc_id", "left").select(
        "part", "bits", "rows", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    )
    nameless = audited.where("doc_id is null").select("part", "bits", F.lit(1).alias("rows"), F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    return documents.unionByName(nameless).groupBy("part", "bits", "good", "toxic").agg(F.sum("rows").alias("n"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: what the step removes and what of it others would have removed.

    Columns ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley`` and ``filter``, the step's letter.  ``docs`` has ``doc_id, text,
    source``, ``labels`` has ``doc_id, quality, toxic``; other columns are not read.  Every part
    has all orders and steps, also where nothing is removed; an empty table has no part and
    no rows.  For NULLs, repeated rows and labels see ``combinations``; very long texts are
    counted whole.
    """
    kinds = range(1 << len(LETTERS))

    def counted(which: Column) -> Column:
        """Documents by combination, as an array that the combination indexes."""
        return F.array(*[F.coalesce(F.sum(F.when((F.col("bits") == b) & which, F.col("n"))), F.lit(0)) for b in kinds])

    parts = combinations(docs, labels).groupBy("part").agg(
        counted(F.lit(True)).alias("all"), counted(F.col("good")).alias("good"), counted(F.col("toxic")).alias("toxic")
    )
    orders = F.array(*[F.lit("".join(p)) for p in permutations(LETTERS)])
    step, order = F.col("step"), F.col("filter_order")
    mask = lambda letters: sum((F.when(F.instr(letters, x) > 0, bit(x)).otherwise(0) for x in LETTERS), F.lit(0))
    steps = (
        parts.withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))))
        .withColumn("filter", F.substring(order, step, F.lit(1)))
        .withColumns({"own": mask(F.col("filter")), "before": mask(F.substring(order, F.lit(1), step - 1))})
    )

    def total(counts: str, test) -> Column:
        chosen = F.transform(counts, lambda n, b: F.when(test(b), n).otherwise(0))
        return F.aggregate(chosen, F.lit(0).cast("long"), lambda a, n: a + n)

    own, before = F.col("own"), F.col("before")
    fails = lambda b: b.bitwiseAND(own) != 0
    gone = lambda b: b.bitwiseAND(before) != 0
    removed = total("all", lambda b: fails(b) & ~gone(b))
    measured = steps.select(
        "part",
        "filter_order",
        step.cast("int").alias("step"),
        "filter",
        total("all", lambda b: ~fails(b) & ~gone(b)).alias("kept"),
        removed.alias("removed"),
        total("all", lambda b: fails(b) & gone(b)).alias("redundant"),
        total("all", lambda b: b == own).alias("unique_fails"),
        total("good", lambda b: fails(b) & ~gone(b)).alias("good_lost"),
        total("toxic", lambda b: fails(b) & ~gone(b)).alias("toxic_lost"),
    )
    # A window holds the steps of one filter in all orders, a fixed number of rows.
    return measured.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter")))
