"""The languages a document is mixed of, by expectation-maximisation over n-gram likelihoods.

A word's likelihood in a language is that of its bytes, one after the other, given the
bytes before: interpolated n-grams of one to ``ORDER`` bytes.  A document is a
mixture: each of its words comes from one of the languages, in proportions that
expectation-maximisation finds.  Languages join a document's set, the largest proportion
first, while the likelihood grows by more than a further language costs.

The n-grams are counted over all learning documents, in tasks and then by one combined sum.
A language's counts are hashed into ``ORDERS * BUCKETS`` places, so its model has a fixed size
whatever the corpus; at most ``MOST_LANGUAGES`` models are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roastery.llm import words as W
from roastery.llm.labelled import held_out

ORDER = 4  # bytes, as many as fit a 32-bit number
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
TABLES = 2 * ORDER  # for each order its n-grams, and what comes before their last byte
MODEL = TABLES * BUCKETS  # counts of one language, a megabyte as float32
#: Languages beyond this many, those with the fewest documents, are not learned: bounds the broadcast.
MOST_LANGUAGES = 200
UNKNOWN = "und"
MODULUS, HELD_OUT = 3, 1
TRUST = 2.0  # counts a shorter n-gram's estimate is worth
ROUNDS = 12
PENALTY = 3.0  # of log-likelihood a further language costs, times the log of the words
EVEN = 0.1  # share of even proportions in the score
END = 1  # stands after a word, 0 before it: neither is part of a word
CHUNK_BYTES = 4 << 20  # words repeat, so a large chunk has fewer different ones to judge
FLUSH = 64  # languages whose counts a task holds at once


@dataclass
class Vocabulary:
    """Different words of a chunk; ``places`` has, for each table, the model place of every byte of each and of its end."""

    words: W.Words
    which: np.ndarray  # for each word of the chunk its place among the different ones
    places: np.ndarray  # (TABLES, bytes)
    first: np.ndarray  # where each different word starts in places

    @classmethod
    def of(cls, texts: pa.Array) -> Vocabulary:
        words = W.split(letters(texts))
        _, at, which = np.unique(words.hashes(0), return_index=True, return_inverse=True)
        lengths = words.ends[at] - words.starts[at]
        # The different words side by side, each behind ORDER - 1 zeros and before its end.
        room = lengths + ORDER
        line = np.zeros(int(room.sum()), np.uint32)
        to = np.cumsum(room) - room + ORDER - 1
        inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        line[np.repeat(to, lengths) + inside] = words.data[np.repeat(words.starts[at], lengths) + inside]
        line[to + lengths] = END
        key = line.copy()
        for back in range(1, ORDER):
            key[back:] |= line[:-back] << np.uint32(8 * back)
        key = key[line != 0]
        places = np.empty((TABLES, len(key)), np.int32)
        factors = (W.constants(TABLES, 91) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        for order in range(ORDER):
            for kind, known in ((0, order + 1), (1, order)):
                run = (key >> np.uint32(8 * kind)) & np.uint32((1 << 8 * known) - 1)
                table = 2 * order + kind
                places[table] = (run * factors[table] >> np.uint32(32 - BUCKET_BITS)).astype(np.int32) + table * BUCKETS
        return cls(words, which, places, np.cumsum(lengths + 1) - (lengths + 1))


def letters(texts: pa.Array) -> pa.Array:
    """Lower-case letters and marks, runs of everything else as one space; NULL is empty."""
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), "")), r"[^\p{L}\p{M}]+", " ")


def count(texts: pa.Array) -> np.ndarray:
    """n-grams of all words of the texts, by model place."""
    found = Vocabulary.of(texts)
    if not len(found.words):
        return np.zeros(MODEL)
    times = np.bincount(found.which, minlength=len(found.first)).astype(float)
    weights = np.repeat(times, np.diff(np.append(found.first, found.places.shape[1])))
    return sum(np.bincount(places, weights, MODEL) for places in found.places)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], ["lang", "place", "n"]
            )
        held.clear()

    for batch in batches:
        for lang in pc.unique(batch.column("lang")).to_pylist():
            own = batch.filter(pc.equal(batch.column("lang"), lang))
            for part in W.chunks(own, "text", CHUNK_BYTES):
                counts = count(part.column("text"))
                held[lang] = held[lang] + counts if lang in held else counts
            if len(held) >= FLUSH:
                yield from flush()
    yield from flush()


def _pack(key: tuple, rows: pa.Table) -> pa.Table:
    counts = np.zeros(MODEL, np.float32)
    counts[rows.column("place").to_numpy()] = rows.column("n").to_numpy()
    return pa.table({"lang": [key[0].as_py()], "counts": pa.array([counts.tobytes()], pa.binary())})


@dataclass
class Mixture:
    """Languages in order, and their counts as (model place, language)."""

    languages: list[str]
    counts: np.ndarray

    def chunk_bytes(self) -> int:
        """Text worked on at once: less of it the more languages there are."""
        return max(1 << 18, CHUNK_BYTES * 4 // max(4, len(self.languages)))

    def likelihoods(self, found: Vocabulary) -> np.ndarray:
        """Log-likelihood of each different word in each language, as (language, word)."""
        if not len(found.first):
            return np.zeros((len(self.languages), 0), np.float32)
        chance = np.full((found.places.shape[1], len(self.languages)), 1 / 256, np.float32)
        trust = np.float32(TRUST)
        for order in range(ORDER):
            seen, before = self.counts[found.places[2 * order]], self.counts[found.places[2 * order + 1]]
            # Places are shared by hashing, so a count may exceed what it is a part of.
            chance *= trust
            chance += np.minimum(seen, before, out=seen)
            before += trust
            chance /= before
        return np.ascontiguousarray(np.add.reduceat(np.log(chance, out=chance), found.first, axis=0).T)

    def infer(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Per text: proportions of the languages of its set (others 0), and how likely each language is for its words."""
        found = Vocabulary.of(texts)
        n, k = len(texts), len(self.languages)
        shares, sure = np.zeros((n, k)), np.zeros((n, k))
        sizes = found.words.counts()
        some = np.flatnonzero(sizes > 0)
        if not len(some) or not k:
            return shares, sure
        sizes = sizes[some]
        logs = self.likelihoods(found)
        top = logs.max(axis=0)
        odds = np.exp(logs - top)[:, found.which]  # per word, relative to its likeliest language
        alone = _per_text(logs[:, found.which], sizes)
        top = _per_text(top[None, found.which], sizes)[0]
        everything = np.arange(len(some))

        def likelihood(proportions: np.ndarray, mine: np.ndarray, docs: np.ndarray) -> np.ndarray:
            each = np.einsum("kt,kt->t", mine, np.repeat(proportions, sizes[docs], axis=1))
            return _per_text(np.log(each + np.float32(1e-30))[None], sizes[docs])[0] + top[docs]

        def maximise(proportions: np.ndarray, mine: np.ndarray, docs: np.ndarray) -> np.ndarray:
            for _ in range(ROUNDS):
                part = np.repeat(proportions, sizes[docs], axis=1)
                part *= mine
                part /= part.sum(axis=0) + np.float32(1e-30)
                proportions = (_per_text(part, sizes[docs]) / sizes[docs]).astype(np.float32)
            return proportions

        even = maximise(np.full((k, len(some)), 1 / k, np.float32), odds, everything)
        # The first language is the one that explains the text best alone, the others follow by proportion.
        best = alone.argmax(axis=0)
        ranking = even.copy()
        ranking[best, everything] = 2
        ranking = np.argsort(-ranking, axis=0, kind="stable")
        chosen = np.zeros((k, len(some)), np.float32)
        chosen[best, everything] = 1
        worth = alone[best, everything]
        cost = PENALTY * np.log1p(sizes)
        # No set gains more than all languages together, which leaves most texts with their first.
        growing = np.flatnonzero(likelihood(even, odds, everything) - cost > worth)
        for size in range(2, k + 1):
            if not len(growing):
                break
            allowed = np.zeros((k, len(growing)), np.float32)
            np.put_along_axis(allowed, ranking[:size, growing], 1, axis=0)
            trial = (even[:, growing] + np.float32(1e-6)) * allowed
            mine = odds[:, np.repeat(np.isin(everything, growing), sizes)]
            trial = maximise(trial / trial.sum(axis=0), mine, growing)
            gained = likelihood(trial, mine, growing) - cost[growing] * (size - 1)
            better = gained > worth[growing]
            growing, gained, trial = growing[better], gained[better], trial[:, better]
            worth[growing], chosen[:, growing] = gained, trial
        part = odds * np.repeat(np.float32(1 - EVEN) * chosen + np.float32(EVEN / k), sizes, axis=1)
        part /= part.sum(axis=0) + np.float32(1e-30)
        shares[some], sure[some] = chosen.T, (_per_text(part, sizes) / sizes).T
        return shares, sure


def _per_text(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums over the words of each text, none of them without words; in double, so that long texts add up."""
    return np.add.reduceat(words, np.cumsum(sizes) - sizes, axis=1, dtype=np.float64)


def learn(docs: DataFrame, modulus: int, remainder: int, most: int = MOST_LANGUAGES) -> Mixture:
    """Counts of every language over all its learning documents; at most ``most`` models reach the driver."""
    learning = docs.where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id"), modulus, remainder)
    ).select("lang", "text")
    kept = learning.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most).select("lang")
    counted = learning.join(F.broadcast(kept), "lang", "left_semi").select("lang", "text").mapInArrow(_count, "lang string, place int, n double")
    summed = counted.groupBy("lang", "place").agg(F.sum("n").alias("n"))
    # A group has one row for each place of the model at most.
    models = summed.groupBy("lang").applyInArrow(_pack, "lang string, counts binary").collect()
    models = sorted((m["lang"], m["counts"]) for m in models)
    counts = [np.frombuffer(bytes(c), np.float32) for _, c in models]
    return Mixture([lang for lang, _ in models], np.stack(counts, 1) if counts else np.zeros((MODEL, 0), np.float32))


def identify(docs: DataFrame, modulus: int = MODULUS, remainder: int = HELD_OUT, most_languages: int = MOST_LANGUAGES) -> DataFrame:
    """Per row: ``doc_id, held_out, lang_pred, score, languages``.

    ``languages`` is the selected set, ``(lang, share)`` by falling share, and ``lang_pred`` its first;
    of equal shares the language that comes first by name.  ``score`` is the mean chance that a word is of ``lang_pred``.
    Models are learned from ``text`` and ``lang`` of rows that are not held out (by the checksum of ``doc_id``);
    rows without id or language teach nothing.  A text that is NULL, empty or without a letter is
    ``und`` with score 0 and an empty set, and so is every text if nothing could be learned.
    Texts are read whole, whatever their length; rows are judged one by one, so repeated rows and
    NULL ids pass as they are, and an empty table gives no rows.  Other columns are not read.
    """
    mixture = docs.sparkSession.sparkContext.broadcast(learn(docs, modulus, remainder, most_languages))
    member = pa.struct([("lang", pa.string()), ("share", pa.float64())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = mixture.value.languages
        for batch in batches:
            for part in W.chunks(batch, "text", mixture.value.chunk_bytes()):
                texts = part.column("text")
                shares, sure = mixture.value.infer(texts)
                known = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
                known = known & (shares.sum(axis=1) > 0) if names else np.zeros(len(texts), bool)
                best = shares.argmax(axis=1) if names else np.zeros(len(texts), int)
                sets = []
                for row, own in zip(shares, known):
                    order = np.argsort(-row, kind="stable")
                    sets.append([{"lang": names[i], "share": float(row[i])} for i in order if row[i] > 0] if own else [])
                score = [float(min(sure[i, best[i]], 1)) if own else 0.0 for i, own in enumerate(known)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([names[b] if own else UNKNOWN for b, own in zip(best, known)], pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array(sets, pa.list_(member)),
                    ],
                    ["doc_id", "lang_pred", "score", "languages"],
                )

    judged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        judge, "doc_id long, lang_pred string, score double, languages array<struct<lang:string,share:double>>"
    )
    return judged.select("doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "lang_pred", "score", "languages")
