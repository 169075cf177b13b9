"""Secrets in texts: a trigram index picks the candidates, regular expressions verify them.

Each rule's expression is reduced, on the driver, to a Boolean query over three-letter
pieces that every match must contain.  The index lists, for each piece that a query
names, the documents that contain it, upper and lower case alike; a rule's candidates
follow from intersecting its pieces' postings, and alternatives add theirs.  Candidates
are verified by the expression itself.  A rule without a mandatory piece, such as a run
of hexadecimal digits, is verified on every document.  All data work is column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roastery.llm.native import LAST, let, prefix_sums

_MOST_ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern`` that do not overlap and whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three kinds whose spans the contract gives.
BASE = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),  # whole runs of [0-9a-f]+ with 16 characters or more
]
MORE = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]
RULES = BASE + MORE


def _extend(states: list[tuple[tuple[str, ...], str]], parsed) -> list[tuple[tuple[str, ...], str]]:
    """Literal runs so far (done, running) of each way through an expression."""

    def stop(states):
        return list(dict.fromkeys(((*done, run), "") if run else (done, "") for done, run in states))

    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            states = [(done, run + chr(value).lower()) for done, run in states]
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in value) and len(value) <= 8:
            states = [(done, run + chr(c).lower()) for done, run in states for _, c in value]
        elif name == "SUBPATTERN":
            states = _extend(states, value[-1])
        elif name == "BRANCH":
            states = [s for branch in value[1] for s in _extend(states, branch)]
        elif name == "MAX_REPEAT" and value[:2] == (0, 1) and all(str(o) != "IN" for o, _ in value[2]):
            states = states + _extend(states, value[2])
        elif name == "MAX_REPEAT" and value[0] >= 1:
            once = _extend(states, value[2])
            states = once if value[:2] == (1, 1) else stop(once)
        else:
            states = stop(states)
        states = list(dict.fromkeys(states))
        if len(states) > _MOST_ALTERNATIVES:
            states = [((), "")]  # asks for nothing: always true, never a loss
    return states


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Sets of lower-case trigrams, one of which every match contains whole; None if some match need contain none."""
    found = set()
    for done, run in _extend([((), "")], re._parser.parse(pattern)):
        found.add(frozenset(r[i : i + 3] for r in (*done, run) for i in range(len(r) - 2)))
    if frozenset() in found:
        return None
    return sorted((f for f in found if not any(other < f for other in found)), key=sorted)


def trigram_index(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """Postings ``trigram, id`` of the asked trigrams, case folded, from ``docs`` with columns ``id, text``."""
    asked = F.array(*[F.lit(t) for t in trigrams])
    has = let(F.lower("text"), lambda folded: F.filter(asked, lambda t: F.contains(folded, t)))
    return docs.select("id", F.explode(has).alias("trigram")).select("trigram", "id")


def candidates(postings: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``id, rules``: names of the indexed rules whose query a document's postings fulfil."""
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    held = postings.groupBy("id").agg(F.collect_set("trigram").alias("held"))
    names = []
    for kind, query in queries.items():
        if query is None:
            continue
        # All postings of a set meet in a document if none of the set is missing there.
        fulfilled = F.lit(False)
        for pieces in query:
            fulfilled = fulfilled | (F.size(F.array_except(F.array(*[F.lit(t) for t in sorted(pieces)]), "held")) == 0)
        names.append(F.when(fulfilled, F.lit(kind)))
    if not names:
        return held.select("id", F.array().cast("array<string>").alias("rules")).limit(0)
    return held.select("id", F.array_compact(F.array(*names)).alias("rules")).where(F.size("rules") > 0)


def spans_of(text: Column, rule: Rule) -> Column:
    """Array of ``kind, start, end`` of a rule's matches, in code points: lengths of matches and of the text between them add up to places."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else matches

    def placed(found: Column) -> Column:
        between = F.split(text, rule.pattern)
        steps = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda m, b: (F.length(m) + F.length(b)).cast("long"))
        starts = F.zip_with(prefix_sums(steps), F.slice(between, 1, F.size(found)), lambda s, b: s + F.length(b))
        ends = F.zip_with(starts, found, lambda s, m: s + F.length(m))
        rows = F.zip_with(
            F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), e.alias("end"))),
            groups,
            lambda p, g: F.struct(F.lit(rule.kind).alias("kind"), p["start"].alias("start"), p["end"].alias("end"), F.length(g).alias("size")),
        )
        return F.transform(F.filter(rows, lambda r: r["size"] >= rule.least), lambda r: F.struct(r["kind"], r["start"], r["end"]))

    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return F.when(text.rlike(rule.pattern), let(matches, placed)).otherwise(none)


def scan(docs: DataFrame, rules: Sequence[Rule] = tuple(RULES), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: ``doc_id, spans``, an array of ``kind, start, end`` by start and the order of ``rules``; places in code points, end exclusive.

    NULL and empty texts have no spans.  Rows with one id share their candidates and
    are verified one by one, so repeated rows give equal results; rows without an id are
    scanned like others.  Other columns are not read, whatever their names.
    """
    own = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    own = own.withColumn("id", F.coalesce("doc_id", F.lit(LAST)))
    queries = [trigram_query(rule.pattern) for rule in rules]
    asked = sorted({t for query in queries if query for pieces in query for t in pieces})
    if asked:
        own = own.join(candidates(trigram_index(own, asked), rules), "id", "left")
    else:
        own = own.withColumn("rules", F.array().cast("array<string>"))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    found = []
    for rule, query in zip(rules, queries):
        spans = spans_of(F.col("text"), rule)
        found.append(spans if query is None else F.when(F.array_contains("rules", rule.kind), spans).otherwise(none))
    order = {rule.kind: i for i, rule in enumerate(rules)}
    number = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    keyed = F.transform(F.concat(*found), lambda s: F.struct(s["start"], number[s["kind"]].alias("at"), s["end"], s["kind"]))
    return own.select("doc_id", F.transform(F.sort_array(keyed), lambda s: F.struct(s["kind"], s["start"], s["end"])).alias("spans"))
