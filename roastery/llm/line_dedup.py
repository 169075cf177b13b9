"""Removal of repeated runs of lines, cut where the content says.

A rolling hash over the last lines ends a chunk wherever it falls on a multiple of a
fixed number, so boundaries move with the content: the same passage is cut alike wherever
it stands.  Chunks of several lines are counted by hash over the corpus, narrow
rows only; those found more than once are then compared byte by byte and all
occurrences but the first go.  All of it is column expressions.

A chunk in a third of all documents is reduced on the map side both times, and the join that
tells its occurrences from the first has one row of it on its small side.

Such chunks miss passages of a few lines, as lines next to a passage take part in its
chunks.  ``dedup_passages`` has no boundaries: from every line the shortest run of lines
with enough words, forward and backward, is compared, and these cover every passage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roastery.llm.native import LAST, let, prefix_sums, sized, words
from roastery.storage import materialize

DIVISOR = 4  # lines per chunk, on average
ROLL = 3  # lines the rolling hash sees
BASE = 1_000_003
PRIME = 2_147_483_647
LEAST_WORDS = 51  # of a passage


def line_number(line: Column) -> Column:
    """32 bits of a line's digest."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def chunk_places(lines: Column, divisor: int = DIVISOR, roll: int = ROLL) -> Column:
    """Array of ``start, size`` (in lines) of the chunks of an array of lines."""

    def of(numbers: Column) -> Column:
        def rolled(i: Column) -> Column:
            out = F.lit(0).cast("long")
            for back in range(roll - 1, -1, -1):
                out = (out * BASE + F.coalesce(F.get(numbers, i - back), F.lit(0)) % PRIME) % PRIME
            return out

        ends = F.filter(
            F.sequence(F.lit(0), F.size(numbers) - 1), lambda i: (i == F.size(numbers) - 1) | (rolled(i) % divisor == 0)
        )
        before = lambda e, k: F.coalesce(F.get(e, k - 1) + 1, F.lit(0))
        return let(
            ends, lambda e: F.transform(e, lambda end, k: F.struct(before(e, k).alias("start"), (end - before(e, k) + 1).alias("size")))
        )

    return let(F.transform(lines, line_number), of)


def _chunks(docs: DataFrame, divisor: int, roll: int) -> DataFrame:
    """``id, of, place, chunk``: every multi-line chunk with a word in it; ``of`` tells texts of one id apart."""
    cut = docs.select("id", "of", F.split("text", "\n").alias("lines")).where(F.size("lines") > 1)
    placed = cut.select("id", "of", "lines", chunk_places(F.col("lines"), divisor, roll).alias("places"))
    texts = F.transform(
        "places",
        lambda p, k: F.struct(
            k.alias("place"), p["size"].alias("size"), F.array_join(F.slice("lines", p["start"] + 1, p["size"]), "\n").alias("chunk")
        ),
    )
    real = F.filter(texts, lambda c: (c["size"] > 1) & c["chunk"].rlike(r"[^\x20\x09-\x0D]"))
    return placed.select("id", "of", F.explode(real).alias("c")).select("id", "of", "c.place", "c.chunk")


def dedup_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", divisor: int = DIVISOR, roll: int = ROLL
) -> DataFrame:
    """``row, text, n_chunks_removed``: the columns of ``docs`` as a struct, and the text that is left.

    Of equal multi-line chunks the one in the smallest id, then at the earliest place, stays; the
    lines of the others go with their line ends.  Single lines never go, whatever their number.
    NULL texts stay NULL, empty ones empty.  NULL ids come after all others.  Rows
    with one id are one document: those with equal texts give equal results.
    A struct keeps other columns apart, whatever their names.
    """
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("id"),
        F.col(text_column).alias("text"),
    ).withColumn("of", F.xxhash64("text"))
    hashed = _chunks(own.select("id", "of", "text"), divisor, roll)
    narrow = hashed.select("id", "of", "place", F.xxhash64("chunk").alias("h"))
    repeated = narrow.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    again = materialize(
        hashed.withColumn("h", F.xxhash64("chunk")).join(repeated, "h", "left_semi"), "repeated-chunks"
    )
    # Equal bytes, not only equal hashes, make a group.
    first = again.groupBy("h", "chunk").agg(F.min(F.struct("id", "place")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = (
        again.join(first, ["h", "chunk"])
        .where((F.col("id") != F.col("first.id")) | (F.col("place") != F.col("first.place")))
        .groupBy("id", "of")
        .agg(F.collect_set("place").alias("gone"))
    )

    def rest(lines: Column) -> Column:
        kept = F.filter(chunk_places(lines, divisor, roll), lambda p, k: ~F.array_contains("gone", k))
        return F.array_join(F.flatten(F.transform(kept, lambda p: F.slice(lines, p["start"] + 1, p["size"]))), "\n")

    joined = own.join(gone, ["id", "of"], "left")
    return joined.select(
        "row",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(let(F.split("text", "\n"), rest)).alias("text"),
        F.coalesce(F.size("gone"), F.lit(0)).alias("n_chunks_removed"),
    )


def passage_windows(lines: Column, least: int = LEAST_WORDS) -> Column:
    """Array of ``start, end, h, g``: the shortest runs with ``least`` words from each line on and up to each line.

    Lines without a word are passed over, so a run has at most ``least`` others.  Equal runs of lines
    are cut alike wherever they stand, and the cuts of a longer run cover all its lines: those from its
    lines on, and the one up to its last line.  ``h`` and ``g`` are 128 bits of the lines.
    """

    def of(own: Column, before: Column, x: Column, y: Column) -> Column:
        till = lambda k: F.get(before, k) + F.get(own, k)["n"]
        short = lambda k: F.size(F.filter(F.sequence(k, F.least(k + least, F.size(own)) - 1), lambda j: till(j) - F.get(before, k) < least))
        first = lambda k: F.greatest(k - least + 1, F.lit(0))
        enough = lambda k: F.size(F.filter(F.slice(before, first(k) + 1, k - first(k) + 1), lambda b: till(k) - b >= least))
        span = lambda s, e: F.struct(s.alias("s"), e.alias("e"))
        on = F.transform(own, lambda o, k: span(k, F.when(o["n"] >= least, k).otherwise(k + short(k))))
        up = F.transform(own, lambda o, k: span(F.when(o["n"] >= least, k).otherwise(first(k) + enough(k) - 1), k))
        # A run too short for ``least`` words ends outside, or starts before the first place looked at.
        whole = F.concat(F.filter(on, lambda w: w["e"] < F.size(own)), F.filter(up, lambda w: till(w["e"]) - F.coalesce(F.get(before, w["s"]), till(w["e"])) >= least))
        return F.transform(
            F.array_distinct(whole),
            lambda w: F.struct(
                F.get(own, w["s"])["at"].alias("start"),
                F.get(own, w["e"])["at"].alias("end"),
                F.xxhash64(F.slice(x, w["s"] + 1, w["e"] - w["s"] + 1)).alias("h"),
                F.xxhash64(F.lit(9), F.slice(y, w["s"] + 1, w["e"] - w["s"] + 1)).alias("g"),
            ),
        )

    numbered = F.transform(
        lines, lambda l, i: F.struct(i.alias("at"), F.size(words(l)).alias("n"), F.xxhash64(l).alias("x"), F.xxhash64(F.lit(7), l).alias("y"))
    )
    part = lambda own, name: F.transform(own, lambda o: o[name])
    return let(
        F.filter(numbered, lambda o: o["n"] > 0),
        lambda own: let(
            prefix_sums(F.transform(own, lambda o: o["n"].cast("long"))),
            lambda before: let(part(own, "x"), lambda x: let(part(own, "y"), lambda y: of(own, before, x, y))),
        ),
    )


def dedup_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """``row, text, n_lines_removed``: the columns of ``docs`` as a struct, and the text without repeated passages.

    A passage is a run of whole lines, one or more, with at least ``least`` words together; blank
    lines do not part it.  Of equal passages the one in the smallest id, then at the earliest place,
    stays; all lines of the others go, with blank lines inside.  A passage that overlaps with its own
    repetition loses the repeated lines, and every line that goes stays somewhere earlier.  Equal means
    128 equal bits.  NULL and empty texts stay; NULL ids come after all others.  Rows with one id are
    told apart by their texts, and those with equal texts give equal results.
    """
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("id"),
        F.col(text_column).alias("text"),
    ).withColumn("of", F.xxhash64("text"))
    cut = own.where("text is not null").select("id", "of", F.explode(passage_windows(F.split("text", "\n"), least)).alias("w")).select("id", "of", "w.*")
    repeated = materialize(cut.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "repeated-windows")
    again = materialize(cut.join(sized(repeated), "h", "left_semi"), "repeated-passages")
    place = F.struct("id", "of", "start")
    first = materialize(again.groupBy("h", "g").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "first-passages")
    later = again.join(sized(first), ["h", "g"]).where(place != F.col("first"))
    gone = materialize(later.groupBy("id", "of").agg(F.collect_set(F.struct("start", "end")).alias("gone")), "gone-passages")

    def kept(lines: Column) -> Column:
        places = F.flatten(F.transform("gone", lambda w: F.sequence(w["start"], w["end"])))
        return F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places)

    def rest(lines: Column) -> Column:
        return let(
            kept(lines),
            lambda k: F.struct(F.array_join(F.transform(k, lambda i: F.get(lines, i)), "\n").alias("text"), (F.size(lines) - F.size(k)).alias("n")),
        )

    joined = own.join(sized(gone), ["id", "of"], "left").withColumn("rest", F.when(F.col("gone").isNotNull(), let(F.split("text", "\n"), rest)))
    return joined.select(
        "row",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.col("rest.text")).alias("text"),
        F.coalesce("rest.n", F.lit(0)).alias("n_lines_removed"),
    )
