"""Near-duplicate groups by b-bit MinHash, confirmed on full shingle sets.

1. One pass gives each document its set size, a 128-bit digest of the set, the
   band keys of its minima, and the low bits of the minima packed into longs.
2. Documents with equal sets form one class, reduced to its smallest id before
   anything else, so that a text copied into a third of all rows is one row.
3. Classes that share a band key are candidates.  In each key one member, the
   head, is compared with the others, so work is linear in the members; keys
   whose members are already one component are done, the head leaves the rest,
   and the next step goes on with what is mixed.  Then members that share too few
   shingles with all others are ruled out.  When few pairs of different components
   are left, they are compared directly, so no link is passed over.
4. When many are left, as in a large group of copies with changes around the limit, the
   shingles that most of a group's members hold are its base, and a member is what it
   differs by from the base.  Two members hold ``|X ^ Y| = |X ^ B| + |Y ^ B| - 2 shared
   differences`` apart, so a link needs a known number of shared differences: members are
   dealt to keys of their rarest differences, enough of them that any two with that many in
   common meet in one.  A key's members are dealt again, by what they share besides, until few
   pairs are left.  What needs no more shared differences is linked with the key's least
   different member.  Nothing is left out, whatever the base.
5. A comparison first counts equal packed minima (bit counts, corrected for the
   chance agreement of low bits), far enough below the limit that a true link
   does not fail it, and then confirms on the full sets.  What is compared directly
   gets eight times as many minima, so that fewer pairs below the limit reach the full
   sets; differences need none, they rule out nearly all such pairs.

Links within one component need no confirmation for the result, which is each
document's component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roastery.llm import words as W
from roastery.llm.components import components
from roastery.storage import materialize, scratch_path, scratch_scope

SHINGLE = 5
SIMILARITY = (80, 100)
BANDS = 32  # a pair at 0.8 shares no band key with probability (1 - 0.8 ** 4) ** 32, 5e-8
ROWS = 4
BITS = 2
FUNCTIONS = 512  # minima whose low bits are kept; the first BANDS * ROWS make the band keys
SIGMAS = 5  # how far below the expected agreement the estimate of a link may lie: 3e-7 of links at the limit
PRODUCTS = 1 << 19  # hash values worked on at once
SHARPER = 4096  # minima of the members that are compared directly after the heads
HEAD_ROUNDS = 1
FEW_PAIRS = 4  # per member, compared directly
BROADCAST_ROWS = 1_000_000  # of one long
NAMELESS = 2**62  # nodes from here on are rows without id


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; shorter texts give one shingle, empty ones none."""
    words = W.split(texts, lower=True)
    hashes = words.hashes(0)
    grams = W.grams(hashes, n, 51)
    out = []
    for start, end in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if end - start >= n:
            out.append(np.unique(grams[start : end - n + 1]))
        elif end > start:
            out.append(W.grams(hashes[start:end], end - start, 101 + end - start))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def minima(shingles: np.ndarray, functions: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set; bounded memory for any size."""
    out = np.full(len(functions), np.iinfo(np.uint64).max)
    step = max(64, PRODUCTS // len(functions))
    for at in range(0, len(shingles), step):
        np.minimum(out, (functions[:, None] * shingles[None, at : at + step]).min(axis=1), out=out)
    return out


def packed(low: np.ndarray, bits: int) -> np.ndarray:
    """The low ``bits`` of the mixed minima, side by side in 64-bit numbers.

    Unmixed, the low bits of a product depend on those of the shingle alone, alike in every function.
    """
    per = 64 // bits
    shifts = (np.arange(per) * bits).astype(np.uint64)
    return np.bitwise_or.reduce((W.mix(low) & np.uint64((1 << bits) - 1)).reshape(-1, per) << shifts, axis=1)


def _sign(shingle: int, bands: int, rows: int, bits: int, kept: int):
    functions = W.constants(kept, 71)
    factors = W.constants(rows, 73)
    salts = W.constants(bands, 79)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                sizes, one, two, keys, sigs = [], [], [], [], []
                for found in shingle_sets(part.column("text"), shingle):
                    sizes.append(len(found))
                    one.append(int(found.sum(dtype=np.uint64)) if len(found) else 0)
                    two.append(int(W.mix(found ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64)) if len(found) else 0)
                    if len(found):
                        low = minima(found, functions)
                        key = W.mix((low[: bands * rows].reshape(bands, rows) * factors).sum(axis=1, dtype=np.uint64) + salts)
                        keys.append(key.view(np.int64))
                        sigs.append(packed(low, bits).view(np.int64))
                    else:
                        keys.append(np.zeros(0, np.int64))
                        sigs.append(np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(np.array(one, np.uint64).view(np.int64)),
                        pa.array(np.array(two, np.uint64).view(np.int64)),
                        pa.array(keys, pa.list_(pa.int64())),
                        pa.array(sigs, pa.list_(pa.int64())),
                    ],
                    ["id", "n", "d1", "d2", "bands", "bits"],
                )

    return sign


def agreement(a: Column, b: Column, longs: int, bits: int) -> Column:
    """How many packed minima agree: equal groups of ``bits`` bits, counted by bit counts."""
    group = int("0" * (bits - 1) + "1", 2)
    ones = sum(group << (i * bits) for i in range(64 // bits))
    ones = ones - (1 << 64) if ones >= 1 << 63 else ones
    total = F.lit(0)
    for i in range(longs):
        differ = a[i].bitwiseXOR(b[i])
        folded = differ
        for shift in range(1, bits):
            folded = folded.bitwiseOR(F.shiftrightunsigned(differ, shift))
        total = total + F.bit_count(folded.bitwiseAND(F.lit(ones)))
    return F.lit(longs * (64 // bits)) - total


def long_agreement(a: Column, b: Column, bits: int) -> Column:
    """The same for many longs, in a loop."""
    each = F.zip_with(a, b, lambda p, q: agreement(F.array(p), F.array(q), 1, bits))
    return F.aggregate(each, F.lit(0), lambda total, n: total + n)


def corrected(agree: Column, functions: int, bits: int) -> Column:
    """Similarity from the agreement, without what low bits agree by chance."""
    chance = 2.0**-bits
    return (agree / functions - chance) / (1 - chance)


def least_agreement(similarity: float, functions: int, bits: int, sigmas: float = SIGMAS) -> float:
    chance = 2.0**-bits
    p = chance + (1 - chance) * similarity
    return functions * p - sigmas * math.sqrt(functions * p * (1 - p))


def _sharpened(rest: DataFrame, involved: DataFrame, shingle: int, bits: int) -> DataFrame:
    """``id, long``: the low bits of ``SHARPER`` other minima of the members of ``rest``."""
    functions = W.constants(SHARPER, 83)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                signs = [packed(minima(found, functions), bits).view(np.int64) for found in shingle_sets(part.column("text"), shingle)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(signs, pa.list_(pa.int64()))], ["id", "long"])

    members = rest.select(F.col("rep").alias("id")).distinct()
    return materialize(_only(involved.select("id", "text"), members).mapInArrow(sign, "id long, long array<long>"), "sharpened")


def _confirm(shingle: int, similarity: tuple[int, int]):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=8)
        def one(text: str) -> np.ndarray:
            return shingle_sets(pa.array([text]), shingle)[0]

        for batch in batches:
            for part in W.chunks(batch, "text_b"):
                links = []
                columns = (part.column(name).to_pylist() for name in ("a", "b", "text_a"))
                for a, b, text, right in zip(*columns, shingle_sets(part.column("text_b"), shingle)):
                    left = one(text)
                    both = len(np.intersect1d(left, right, assume_unique=True))
                    if similarity[1] * both >= similarity[0] * (len(left) + len(right) - both):
                        links.append((a, b))
                if links:
                    a, b = zip(*links)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return confirm


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is in ``ids``; the ids are broadcast only if counted to be few."""
    few = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(ids) if few else ids, "id", "left_semi")


def _linkable(rest: DataFrame, involved: DataFrame, shingle: int, similarity: tuple[int, int]) -> DataFrame:
    """``rest`` with ``m``, the shingles of a member that any other member has too, and without members that cannot have a link left.

    A shingle no other member has is in no intersection.  So a copy with many changes
    of its own is ruled out by itself, and a large group of such copies needs no
    comparison of all its pairs.
    """

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                sets = shingle_sets(part.column("text"), shingle)
                ids = np.repeat(part.column("id").to_numpy(zero_copy_only=False), [len(s) for s in sets])
                hashes = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes.view(np.int64), pa.int64())], ["id", "h"])

    members = rest.select(F.col("rep").alias("id")).distinct()
    held = _only(involved.select("id", "text"), members).mapInArrow(shingles, "id long, h long")
    alone = held.groupBy("h").agg(F.min("id").alias("id"), F.max("id").alias("other")).where("id = other")
    own = alone.groupBy("id").agg(F.count(F.lit(1)).alias("u"))
    counted = rest.join(own.withColumnRenamed("id", "rep"), "rep", "left").withColumn("m", F.col("n") - F.coalesce("u", F.lit(0))).drop("u")
    least = counted.groupBy("k").agg(F.min("n").alias("least_n"))
    # The best a member can reach in a key: all m shared, with the smallest partner that holds them.
    may = similarity[1] * F.col("m") >= similarity[0] * (F.col("n") + F.greatest("least_n", "m") - F.col("m"))
    return counted.join(least, "k").where(may).drop("least_n")


def _homes(rest: DataFrame) -> DataFrame:
    """``k, id, c``: the members of ``rest`` under fewer keys, so that members of one key are still together.

    Each key goes to the most crowded key that any of its members has.
    """
    crowd = rest.groupBy("k").agg(F.count(F.lit(1)).alias("s"))
    most = rest.join(crowd, "k").groupBy("rep").agg(F.max(F.struct("s", "k")).alias("most"))
    home = rest.join(most, "rep").groupBy("k").agg(F.max("most")["k"].alias("home"))
    return materialize(rest.join(home, "k").select(F.col("home").alias("k"), F.col("rep").alias("id"), "c").distinct(), "homes")


def _differences(homes: DataFrame, involved: DataFrame, shingle: int, similarity: tuple[int, int]) -> DataFrame:
    """``k, rep, v, c, w, items``: the shingles that only the member or only the base of its key holds.

    The base are the shingles that more than half of a key's members hold.  ``w`` is such that members are linked when
    ``2 * sum(similarity) * shared items >= w + w``; ``v`` tells apart texts under one id.
    """
    low, high = similarity

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                sets = shingle_sets(part.column("text"), shingle)
                keys = np.repeat(part.column("k").to_numpy(zero_copy_only=False), [len(s) for s in sets])
                hashes = np.concatenate(sets).view(np.int64)
                order = np.lexsort((hashes, keys))
                keys, hashes = keys[order], hashes[order]
                new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (hashes[1:] != hashes[:-1])])[: len(keys)])
                times = np.diff(np.append(new, len(keys)))
                yield pa.RecordBatch.from_arrays([pa.array(keys[new], pa.int64()), pa.array(hashes[new]), pa.array(times, pa.int64())], ["k", "h", "q"])

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                digests, weights, items = [], [], []
                for found, base in zip(shingle_sets(part.column("text"), shingle), part.column("base")):
                    held = np.asarray(base.values if base.is_valid else [], np.int64)
                    items.append(np.setxor1d(found.view(np.int64), held, assume_unique=True))
                    digests.append(int(W.mix(found).sum(dtype=np.uint64)))
                    weights.append((high + low) * len(items[-1]) - (high - low) * len(found))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("k"),
                        part.column("id"),
                        pa.array(np.array(digests, np.uint64).view(np.int64)),
                        part.column("c"),
                        pa.array(weights, pa.int64()),
                        pa.array(items, pa.list_(pa.int64())),
                    ],
                    ["k", "rep", "v", "c", "w", "items"],
                )

    texts = homes.join(involved.select("id", "text"), "id")
    held = texts.select("k", "text").mapInArrow(counts, "k long, h long, q long").groupBy("k", "h").agg(F.sum("q").alias("q"))
    members = homes.groupBy("k").agg(F.count(F.lit(1)).alias("s"))
    base = materialize(held.join(members, "k").where(F.col("q") * 2 > F.col("s")).groupBy("k").agg(F.collect_list("h").alias("base")), "base")
    found = texts.join(base, "k", "left").select("k", "id", "c", "text", "base")
    return materialize(found.mapInArrow(differ, "k long, rep long, v long, c long, w long, items array<long>"), "differences")


def _dealt(rest: DataFrame, got: int, unit: int) -> tuple[DataFrame, DataFrame]:
    """Members dealt to keys of one shared item more than the ``got`` that those of a key share so far.

    No two members of different components may be linked by ``got`` items alone.  A member whose best partner in the
    key needs ``r`` more goes to all but ``r - 1`` of its items that another component has too, rarest first:
    the first item that two linked members share is among these in both, the others come after it.
    Returns the dealt members, without items, and the members with ordered items, which they are cut from.
    """
    first = rest.groupBy("k").agg(F.min(F.struct("w", "c")).alias("first"))
    other = rest.join(first, "k").groupBy("k").agg(F.first("first").alias("first"), F.min(F.when(F.col("c") != F.col("first.c"), F.col("w"))).alias("second"))
    single = rest.select("k", "rep", "v", "c", "w", F.explode("items").alias("h"))
    times = single.groupBy("k", "h").agg(F.count(F.lit(1)).alias("f"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("k", "h", "f")
    shared = single.join(times, ["k", "h"]).groupBy("k", "rep", "v", "c", "w").agg(F.sort_array(F.collect_list(F.struct("f", "h"))).alias("items"))
    best = F.when(F.col("c") == F.col("first.c"), F.col("second")).otherwise(F.col("first.w"))
    more = F.greatest(F.ceil((F.col("w") + best) / unit) - got, F.lit(1))
    ordered = shared.join(other, "k").select("k", "rep", "v", "c", "w", F.col("items.h").alias("items"), (F.size("items") - more + 1).cast("int").alias("places"))
    ordered = materialize(ordered.where("places > 0"), "ordered")
    placed = ordered.select("k", "rep", "v", "c", "w", F.size("items").alias("size"), F.posexplode(F.slice("items", F.lit(1), F.col("places"))).alias("place", "h"))
    dealt = placed.select(F.xxhash64("k", "h").alias("k"), F.col("k").alias("of"), "rep", "v", "c", "w", "place", (F.col("size") - F.col("place") + got).alias("m"))
    return dealt, ordered.select(F.col("k").alias("of"), "rep", "v", "items")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    similarity: tuple[int, int] = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    bits: int = BITS,
    functions: int = FUNCTIONS,
) -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id, kept``.

    Documents whose sets of distinct ``shingle``-word runs (A-Z in lower case) have
    ``similarity[1] * |intersection| >= similarity[0] * |union|`` are linked;
    ``component_id`` is the smallest id reachable and ``kept`` marks the document with it.
    A text of fewer words is one shingle; NULL, empty and blank texts have none and are
    linked with nothing.  Rows with one id count as one document.  A row without an
    id is linked like others, by its own text, but never gives its component its name; a component
    of only such rows has a NULL ``component_id`` and keeps all its rows.  Ids are below 2**62.  Texts are read
    whole, whatever their length; an empty table gives no rows.  Other columns of ``docs`` are not read, whatever their names.
    """
    spark = docs.sparkSession
    name, text = F.col(id_column).cast("long"), F.col(text_column)
    # A row without id is a node of its own text: the same on every evaluation, and after all ids.
    nameless = F.lit(NAMELESS) + F.shiftrightunsigned(F.xxhash64(text, F.length(text)), 3)
    texts = docs.select(F.coalesce(name, nameless).alias("id"), text.alias("text"))
    signed = materialize(
        texts.mapInArrow(_sign(shingle, bands, rows, bits, functions), "id long, n long, d1 long, d2 long, bands array<long>, bits array<long>"),
        "signatures",
    )
    classes = signed.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"), F.first("bits").alias("bits"))
    classes = materialize(classes, "classes")
    stored = scratch_path(spark, "components")
    with scratch_scope(spark, "minhash"):
        _links(texts, classes, shingle, similarity, bits, functions).write.parquet(stored)
    found = spark.read.schema("node long, component long").parquet(stored)

    named = classes.select("n", "d1", "d2", "rep").join(found, F.col("rep") == F.col("node"), "left")
    named = named.select("n", "d1", "d2", F.coalesce("component", "rep").alias("component"))
    result = signed.select("id", "n", "d1", "d2").join(named, ["n", "d1", "d2"], "left")
    result = result.withColumn("component", F.coalesce("component", "id"))
    real = lambda c: F.when(F.col(c) < NAMELESS, F.col(c))
    return result.select(
        real("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        real("component").alias("component_id"),
        ((F.col("id") == F.col("component")) | (F.col("component") >= NAMELESS)).alias("kept"),
    )


def _links(texts: DataFrame, classes: DataFrame, shingle: int, similarity: tuple[int, int], bits: int, functions: int) -> DataFrame:
    """``node, component`` of the classes that are linked with others.

    The members of a key are rows of a few numbers; signatures and texts are joined to candidate pairs, each
    of which comes once however many keys it shares.
    """
    spark, longs = texts.sparkSession, functions * bits // 64
    keys = classes.select("rep", F.explode("bands").alias("k"))
    crowded = keys.groupBy("k").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("k")
    shared = materialize(keys.join(crowded, "k").distinct(), "shared")
    members = shared.select(F.col("rep").alias("id")).distinct()
    signs = materialize(_only(classes.withColumnRenamed("rep", "id"), members).select("id", "n", "bits"), "signs")
    involved = materialize(_only(texts, members).distinct(), "involved")
    enough = least_agreement(similarity[0] / similarity[1], functions, bits)

    def with_both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(table.select(F.col("id").alias(side), F.col(column).alias(f"{column}_{side}")), side)
        return pairs

    def likely(pairs: DataFrame, sharper: DataFrame | None) -> DataFrame:
        """Candidate pairs whose packed minima leave a link possible."""
        agree = agreement(F.col("bits_a"), F.col("bits_b"), longs, bits)
        left = with_both(pairs, signs, "bits").where(agree >= enough).select("a", "b")
        if sharper is None:
            return left
        agree = long_agreement(F.col("long_a"), F.col("long_b"), bits)
        return with_both(left, sharper, "long").where(agree >= least_agreement(similarity[0] / similarity[1], SHARPER, bits)).select("a", "b")

    def confirmed(pairs: DataFrame, sharper: DataFrame | None, estimate: bool = True) -> DataFrame:
        candidates = materialize(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates")
        left = materialize(likely(candidates, sharper), "likely") if estimate else candidates
        return with_both(left, involved, "text").mapInArrow(_confirm(shingle, similarity), "a long, b long")

    def possible(x: str, y: str) -> Column:
        """Whether two members of a key may be linked: other components, sizes and shared shingles."""
        common = F.least(F.col(f"{x}.m"), F.col(f"{y}.m"))
        by_sets = similarity[1] * common >= similarity[0] * (F.col(f"{x}.n") + F.col(f"{y}.n") - common)
        return (F.col(f"{x}.c") != F.col(f"{y}.c")) & by_sets

    def mixed(members: DataFrame) -> DataFrame:
        """Members of keys with more than one component."""
        several = members.groupBy("k").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("k")
        return members.join(several, "k", "left_semi")

    def left_over(members: DataFrame, cost: Column) -> tuple:
        """The members' costs, and the pairs of different components in the keys; of none, NULL."""
        sizes = members.groupBy("k", "c").agg(F.sum(cost).alias("cost"), F.count(F.lit(1)).alias("s"))
        sizes = sizes.groupBy("k").agg(F.sum("cost").alias("cost"), F.sum("s").alias("s"), F.sum(F.col("s") * F.col("s")).alias("q"))
        return sizes.agg(F.sum("cost"), F.sum((F.col("s") * F.col("s") - F.col("q")) / 2)).first()

    def joined(links: DataFrame, found: DataFrame) -> DataFrame:
        """``found`` with more links, of which only those between its components are followed."""
        for side in ("a", "b"):
            links = links.join(found, F.col(side) == F.col("node"), "left").withColumn(side, F.coalesce("component", side)).select("a", "b")
        merged = components(links)
        new = merged.join(found.select("node"), "node", "left_anti")
        moved = found.join(merged.select(F.col("node").alias("component"), F.col("component").alias("into")), "component", "left")
        return materialize(moved.select("node", F.coalesce("into", "component").alias("component")).unionAll(new), "found")

    def narrowed(rest: DataFrame, found: DataFrame) -> DataFrame:
        """``found`` with all links that are left in ``rest``, by the differences of its members."""
        unit = 2 * sum(similarity)
        enough_for = lambda shared: F.col("x.w") + F.col("y.w") <= unit * shared
        other = (F.col("x.k") == F.col("y.k")) & (F.col("x.c") != F.col("y.c"))
        rest, got = _differences(_homes(rest), involved, shingle, similarity), 0
        while True:
            heads = materialize(rest.groupBy("k").agg(F.min(F.struct("w", "rep", "c")).alias("h")).select("k", "h.*"), "heads")
            proven = rest.alias("x").join(heads.alias("y"), other & enough_for(F.lit(got)))
            found = joined(confirmed(proven.select(F.col("y.rep").alias("a"), F.col("x.rep").alias("b")), None, estimate=False), found)
            again = rest.drop("c").join(found, F.col("rep") == F.col("node"), "left").withColumn("c", F.coalesce("component", "rep"))
            dealt, ordered = _dealt(materialize(mixed(again.drop("node", "component")), "mixed"), got, unit)
            got += 1
            dealt = materialize(mixed(dealt), "dealt")
            cost, pairs_left = left_over(dealt, F.col("m"))
            if cost is None:
                return found
            if pairs_left <= FEW_PAIRS * cost:
                pairs = dealt.alias("x").join(dealt.alias("y"), other & (F.col("x.rep") < F.col("y.rep")) & enough_for(F.least("x.m", "y.m")))
                return joined(confirmed(pairs.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")), None), found)
            after = F.slice("items", F.col("place") + 2, F.size("items") - F.col("place") - 1)
            rest = dealt.join(ordered, ["of", "rep", "v"]).select("k", "rep", "v", "c", "w", after.alias("items"))

    found, sharper = spark.createDataFrame([], "node long, component long"), None
    columns = ["k", "rep", "n", "m"]
    rest = shared.join(signs, F.col("rep") == F.col("id")).withColumn("m", F.col("n")).select(columns)
    for turn in range(HEAD_ROUNDS + 1):
        labelled = rest.join(found, F.col("rep") == F.col("node"), "left").select(*columns, F.coalesce("component", "rep").alias("c"))
        rest = materialize(mixed(labelled), "mixed")
        if turn == 1:
            rest = materialize(mixed(_linkable(rest, involved, shingle, similarity)), "linkable")
        members, pairs_left = left_over(rest, F.lit(1))
        if not members:
            break
        direct = turn and pairs_left <= FEW_PAIRS * members
        if turn == HEAD_ROUNDS and not direct:
            return narrowed(rest, found)
        if direct:
            sharper = _sharpened(rest, involved, shingle, bits)
            of_key = (F.col("x.k") == F.col("y.k")) & (F.col("x.rep") < F.col("y.rep"))
            pairs = rest.alias("x").join(rest.alias("y"), of_key & possible("x", "y"))
            pairs = pairs.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
        else:
            order = F.struct(F.xxhash64("rep", F.lit(turn)).alias("o"), "rep", "c", "n", "m")
            heads = materialize(rest.groupBy("k").agg(F.min(order).alias("h")).select("k", "h.*"), "heads")
            pairs = rest.alias("x").join(heads.alias("y"), (F.col("x.k") == F.col("y.k")) & possible("x", "y"))
            pairs = pairs.select(F.col("y.rep").alias("a"), F.col("x.rep").alias("b"))
            rest = rest.join(heads.select("k", "rep"), ["k", "rep"], "left_anti").select(columns)
        found = joined(confirmed(pairs, sharper), found)
        if direct:
            break
    return found
