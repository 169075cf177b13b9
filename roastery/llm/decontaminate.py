"""Benchmark passages in training texts, found by spaced seeds.

A seed hashes the words of a short stretch at the places a fixed mask keeps, so words at
the other places may differ.  The hashes of all stretches of the training texts meet
those of the benchmark; a hit lines the two texts up, and the words around it are
compared one by one.  A passage counts if a run of words in line agrees in enough of them.
All of it is column expressions; texts are not shuffled, only hits are.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roastery.llm.native import LAST, let, sized, words
from roastery.storage import materialize

#: Kept and ignored places; one word replaced anywhere in nine leaves one of the two untouched more often than not.
MASKS = ("11011001", "10010111")
RUN = 13  # words in line, or the whole item if it is shorter
AGREE = 80  # percent of the run
NOT_WORD = r"[^\p{L}\p{N}]+"
_SEEDS = 2_000_000  # benchmark seeds that may be broadcast; beyond, both sides are shuffled


def tokens(text: Column) -> Column:
    return words(F.lower(text), NOT_WORD)


def _seeds(own: Column, masks: Sequence[str]) -> Column:
    """``place, h`` of every masked stretch of an array of words."""

    def masked(mask: str) -> Column:
        kept = [i for i, c in enumerate(mask) if c == "1"]
        last = F.size(own) - len(mask)
        hashed = lambda i: F.struct(i.alias("place"), F.xxhash64(F.lit(mask), *[F.get(own, i + k) for k in kept]).alias("h"))
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), hashed)).otherwise(F.array().cast("array<struct<place:int,h:bigint>>"))

    return F.concat(*[masked(mask) for mask in masks])


def covering_masks(size: int, agree: int = AGREE) -> list[str]:
    """Masks for an item of ``size`` words: whichever words may differ, one of them ignores all of these.

    The words are parted into groups, and each mask ignores as many groups as words may differ.
    Ignored ends are cut off, so that an item may start before a document or end after it.
    """
    differ = size * (100 - agree) // 100
    groups = min(size, differ + 2)
    of = [i * groups // size for i in range(size)]
    masks = ["".join("0" if g in ignored else "1" for g in of).strip("0") for ignored in combinations(range(groups), differ)]
    return sorted({m for m in masks if m})


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    masks: Sequence[str] = MASKS,
    run: int = RUN,
    agree: int = AGREE,
    covering: bool = False,
) -> DataFrame:
    """``doc_id, item_id, n_agree, n_run, doc_start``: the best overlap of each document and benchmark item.

    A document and an item overlap if, lined up at a seed both have, some run of ``run``
    consecutive item words (all of a shorter item) has ``agree`` percent or more of its words equal to
    the document's.  ``n_agree`` counts them in the best run of ``n_run`` words, ``doc_start`` is its first
    word; ties go to the earliest.  Words are runs of letters and digits in lower case.  Items
    with fewer words than a mask have to be there unchanged, and those below ``run`` words are missed
    where every mask meets a changed word; with ``covering`` such items get masks that find every overlap.  NULL and empty texts on
    either side overlap with nothing.  Repeated rows give one result; rows without an id are
    one document, named NULL.  Other columns are not read, whatever their names.
    """
    own = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("id"), F.col(text_column).alias("text"))
    items = benchmark.select(F.col(item_column).cast("long").alias("item_id"), tokens(F.col(item_text)).alias("item")).where(F.size("item") > 0).distinct()
    longest = max(run if covering else 0, *map(len, masks))
    # Items with fewer words: masks of their own, or one of their length that keeps every word.
    lengths = sorted(r["n"] for r in items.where(F.size("item") < longest).select(F.size("item").alias("n")).distinct().collect())
    own_masks = {n: covering_masks(n, agree) if covering and n < run else ["1" * n] for n in lengths}
    whole = sorted({m for some in own_masks.values() for m in some} - set(masks))
    asked_seeds = F.when(F.size("item") >= longest, _seeds(F.col("item"), masks))
    for n, some in own_masks.items():
        asked_seeds = asked_seeds.when(F.size("item") == n, _seeds(F.col("item"), some))
    asked = items.select("item_id", F.explode(asked_seeds).alias("s")).select("item_id", F.col("s.place").alias("item_place"), F.col("s.h").alias("h"))
    cut = own.select("id", tokens(F.col("text")).alias("words"))
    offered = cut.select("id", F.explode(_seeds(F.col("words"), [*masks, *whole])).alias("s")).select("id", "s.place", "s.h")
    hits = offered.join(sized(asked, _SEEDS), "h").select("id", "item_id", (F.col("place") - F.col("item_place")).alias("shift")).distinct()
    hits = materialize(hits, "hits")  # used three times, and the scan behind it is the work
    lines = hits.groupBy("id", "item_id").agg(F.collect_set("shift").alias("shifts")).join(sized(items), "item_id")
    texts = own.join(sized(hits.select("id").distinct()), "id", "left_semi").select("id", tokens(F.col("text")).alias("words"))
    width = F.least(F.size("item"), F.lit(run))

    def best_of(shift: Column) -> Column:
        """Most agreeing words in a run, with its place, for one way to line up."""
        same = F.transform("item", lambda w, i: F.when(F.get("words", i + shift) == w, 1).otherwise(0))
        counted = lambda s: F.transform(
            F.sequence(F.lit(0), F.size("item") - width),
            lambda at: F.struct(
                F.aggregate(F.slice(s, at + 1, width), F.lit(0), lambda a, b: a + b).alias("n_agree"), (-(at + shift)).alias("minus_start")
            ),
        )
        return let(same, lambda s: F.array_max(counted(s)))

    found = texts.join(lines, "id").select("id", "item_id", width.alias("n_run"), F.array_max(F.transform("shifts", best_of)).alias("best"))
    found = found.where(100 * F.col("best.n_agree") >= agree * F.col("n_run"))
    return (
        found.groupBy("id", "item_id")
        .agg(F.max("n_run").alias("n_run"), F.max("best").alias("best"))
        .select(
            F.when(F.col("id") != LAST, F.col("id")).alias("doc_id"),
            "item_id",
            F.col("best.n_agree").cast("long").alias("n_agree"),
            F.col("n_run").cast("long").alias("n_run"),
            (-F.col("best.minus_start")).cast("long").alias("doc_start"),
        )
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **more) -> DataFrame:
    """``docs`` without the documents that overlap with a benchmark item; all columns stay."""
    found = overlaps(docs, benchmark, **more).select(F.coalesce("doc_id", F.lit(LAST)).alias("_found")).distinct()
    key = F.coalesce(F.col(more.get("id_column", "doc_id")).cast("long"), F.lit(LAST))
    return docs.join(sized(found), key == F.col("_found"), "left_anti")
