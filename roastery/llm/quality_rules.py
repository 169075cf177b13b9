"""Quality rules per document, and lines that too many documents of a host share.

Lines are normalised and hashed; each document counts a line once, and counts are
combined before they are shuffled, per host and line.  A line above its host's limit
is frequent: it is a share of the host's documents, so a host has a bounded number of
them.  Documents are then judged in one pass beside their host's frequent lines, and
rejected when too few words are left without them.  All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roastery.llm.native import BROADCAST_ROWS, SPACES, let, words

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of the words
LINE_SHARE = 0.01  # of a host's documents
LINE_DOCUMENTS = 20  # at least, for a line to be frequent
LEAST_LEFT = 30  # percent of the words
_NO_HOST = "\x00"


def repeat_words(tokens: Column, window: int = WINDOW) -> Column:
    """Words covered by windows that are found twice or more in the text, the first included."""

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = lambda a: F.filter(a, lambda x, k: (F.get(a, k - 1)["h"] == x["h"]) | (F.get(a, k + 1)["h"] == x["h"]))
        starts = let(placed, lambda a: F.sort_array(F.transform(twice(a), lambda x: x["i"])))
        span = lambda p: F.transform(p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window))))
        total = let(starts, lambda p: F.aggregate(span(p), F.lit(0), lambda a, b: a + b))
        # Most texts repeat no window and need no sorting.
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), total).otherwise(F.lit(0))

    def of(own: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(own) - window), lambda i: F.xxhash64(*[F.get(own, i + k) for k in range(window)]))
        return F.when(F.size(own) > window, let(hashes, covered)).otherwise(F.lit(0))

    return let(tokens, of).cast("long")


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, SPACES, " ")))


def lines_of(text: Column) -> Column:
    """Lines with at least one word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def frequent_lines(docs: DataFrame, host: str = "source", text: str = "text", share: float = LINE_SHARE, least: int = LINE_DOCUMENTS) -> DataFrame:
    """``host, line, n``: hashes of normalised lines found in more documents of a host than its limit."""
    own = docs.select(F.coalesce(F.col(host).cast("string"), F.lit(_NO_HOST)).alias("host"), F.col(text).alias("text"))
    lines = own.select("host", F.explode(F.array_distinct(F.transform(lines_of(F.col("text")), lambda x: F.xxhash64(normalised(x))))).alias("line"))
    counted = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least)
    sizes = own.groupBy("host").agg(F.count(F.lit(1)).alias("docs"))
    return counted.join(sizes, "host").where(F.col("n") > share * F.col("docs")).select("host", "line", "n")


def apply_rules(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    share: float = LINE_SHARE,
    least: int = LINE_DOCUMENTS,
    least_left: int = LEAST_LEFT,
) -> DataFrame:
    """Per document: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_frequent_words, text``.

    ``base_failed``: fewer than 20 words, or over 30 % of them in repeated 8-word windows.  ``kept`` also asks
    that ``least_left`` percent of the words are left without frequent lines, and ``text``
    is the text without them.  A line is frequent in its host if more than ``least`` documents and more
    than ``share`` of the host's documents have it; every row is a document, and rows
    without a host form one.  NULL and empty texts have no words and fail; other
    columns are not read, whatever their names.
    """
    own = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(host_column).cast("string"), F.lit(_NO_HOST)).alias("host"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    found = frequent_lines(own, "host", "text", share, least)
    few = found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    hosts = found.groupBy("host").agg(F.collect_set("line").alias("frequent"))
    judged = own.join(F.broadcast(hosts) if few else hosts, "host", "left").select(
        "doc_id", "text", words(F.col("text")).alias("words"), F.coalesce("frequent", F.array().cast("array<long>")).alias("frequent")
    )
    lines = F.split("text", "\n")
    is_frequent = lambda x: F.array_contains("frequent", F.xxhash64(normalised(x))) & x.rlike(r"[^\x20\x09-\x0D]")
    n_frequent = F.aggregate(F.filter(lines, is_frequent), F.lit(0), lambda a, x: a + F.size(words(x)))
    real = lines_of(F.col("text"))
    measured = judged.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        without(F.col("text"), " \t\n\x0b\x0c\r").cast("long").alias("word_chars"),
        (F.length("text") - without(F.col("text"), "#*$%&|<>")).cast("long").alias("n_symbols"),
        let(real, lambda r: F.size(r) - F.size(F.array_distinct(r))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        F.when(F.size("frequent") > 0, n_frequent).otherwise(0).cast("long").alias("n_frequent_words"),
        F.when(F.size("frequent") > 0, F.array_join(F.filter(lines, lambda x: ~is_frequent(x)), "\n")).otherwise(F.col("text")).alias("text"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    left = 100 * (F.col("n_words") - F.col("n_frequent_words")) >= least_left * F.col("n_words")
    return measured.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & left).alias("kept"),
        "n_frequent_words",
        "text",
    )
