"""Text quality by a factorisation machine over hashed words, structure and metadata.

A document is a sparse vector: its words, hashed and weighted by their share of the
text, and standardised figures on its structure and size and on the length its metadata state.  The score is a logistic
function of a linear part and of all pairwise interactions, whose weights are inner
products of low-rank vectors; half the square of their sum less the sum of their squares
gives all pairs in time linear in the features.

The machine is fitted on a bounded sample (``labelled``) and broadcast; every document
is then scored in one pass without a shuffle.
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
from roastery.llm.labelled import held_out, training_sample

WORD_BITS = 12
RANK = 8
EPOCHS = 12
THRESHOLD = 0.7
MODULUS, HELD_OUT = 4, 2
_CLASSES = ["#", "$", "%", "&", "*", "|", "!", ".", ",", "\n"]
_OF_BYTE = np.full(256, len(_CLASSES), np.int64)
_OF_BYTE[[b for b in range(256) if chr(b).isalpha() and b < 128 and chr(b).islower()]] = len(_CLASSES) + 1
_OF_BYTE[[b for b in range(256) if b < 128 and chr(b).isupper()]] = len(_CLASSES) + 2
_OF_BYTE[[b for b in range(256) if b < 128 and chr(b).isdigit()]] = len(_CLASSES) + 3
_OF_BYTE[128:] = len(_CLASSES) + 4
for _i, _c in enumerate(_CLASSES):
    _OF_BYTE[ord(_c)] = _i
_N_CLASSES = len(_CLASSES) + 5
_LINE_ENDS = np.zeros(256, bool)
_LINE_ENDS[10] = True
METADATA = 3
STRUCTURE = _N_CLASSES + 7 + METADATA


def _distinct_share(owner: np.ndarray, hashes: np.ndarray, texts: int, counts: np.ndarray) -> np.ndarray:
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    return np.bincount(o[new], minlength=texts) / np.maximum(counts, 1)


def metadata(texts: pa.Array, stated: np.ndarray | None) -> np.ndarray:
    """Figures on ``n_chars`` as stated (NaN: not at all, which gives zeros): that it is, its size, and how far it is from the text's."""
    if stated is None:
        return np.zeros((len(texts), METADATA))
    known = ~np.isnan(stated)
    size = np.where(known, np.log1p(np.maximum(np.nan_to_num(stated), 0)), 0)
    own = np.log1p(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(float))
    return np.column_stack([known, size, np.where(known, size - own, 0)])


def structure(texts: pa.Array, words: W.Words, hashes: np.ndarray) -> np.ndarray:
    """Figures on the form of each text: shares of byte classes, word shapes, repetition, size."""
    n = len(words.first) - 1
    sizes = np.diff(words.offsets)
    owner = np.repeat(np.arange(n), sizes)
    classes = np.bincount(owner * _N_CLASSES + _OF_BYTE[words.data], minlength=n * _N_CLASSES).reshape(n, _N_CLASSES)
    counts = words.counts()
    of_word = words.owner()
    some = np.maximum(counts, 1)
    last = words.data[words.ends - 1] if len(words) else np.zeros(0, np.uint8)
    marked = np.isin(last, [ord(c) for c in "#$%&*!|"])
    lines = W.split(texts, between=_LINE_ENDS)
    line_counts = lines.counts()
    return np.column_stack(
        [
            classes / np.maximum(sizes, 1)[:, None],
            np.log1p(counts),
            np.log1p(sizes) - np.log1p(counts),
            np.bincount(of_word, (words.ends - words.starts == 1).astype(float), n) / some,
            np.bincount(of_word, marked.astype(float), n) / some,
            _distinct_share(of_word, hashes, n, counts),
            np.log1p(line_counts) - np.log1p(counts),
            _distinct_share(lines.owner(), lines.hashes(), n, line_counts),
        ]
    )


@dataclass
class Sparse:
    """Rows of features: ``values[i]`` of feature ``features[i]`` in row ``rows[i]``, rows in order."""

    rows: np.ndarray
    features: np.ndarray
    values: np.ndarray
    size: int


def hashed_words(words: W.Words, hashes: np.ndarray, bits: int = WORD_BITS) -> Sparse:
    """Word counts under hashed names, each text scaled to length one."""
    n = len(words.first) - 1
    keys, counts = np.unique((words.owner() << bits) | (hashes >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)
    rows = keys >> bits
    norm = np.sqrt(np.bincount(rows, counts.astype(float) ** 2, n))
    return Sparse(rows, keys & ((1 << bits) - 1), counts / norm[rows], n)


@dataclass
class Machine:
    """Bias, linear weights and interaction vectors; how structure figures are standardised."""

    bias: float
    linear: np.ndarray
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def features(self, texts: pa.Array, stated: np.ndarray | None = None) -> Sparse:
        words = W.split(texts, lower=True)
        hashes = words.hashes()
        found = hashed_words(words, hashes)
        whole = np.hstack([structure(texts, W.split(texts), hashes), metadata(texts, stated)])
        figures = np.clip((whole - self.mean) / self.scale, -4, 4)
        n, width = figures.shape
        rows = np.concatenate([found.rows, np.repeat(np.arange(n), width)])
        features = np.concatenate([found.features, np.tile(np.arange(width) + (1 << WORD_BITS), n)])
        return Sparse(rows, features, np.concatenate([found.values, figures.ravel()]), n)

    def raw(self, x: Sparse) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic function, and the sums of vectors per row."""
        vectors = self.vectors[x.features] * x.values[:, None]
        sums = np.column_stack([np.bincount(x.rows, vectors[:, r], x.size) for r in range(vectors.shape[1])])
        squares = np.bincount(x.rows, (vectors**2).sum(axis=1), x.size)
        return self.bias + np.bincount(x.rows, self.linear[x.features] * x.values, x.size) + (np.square(sums).sum(axis=1) - squares) / 2, sums

    def score(self, texts: pa.Array, stated: np.ndarray | None = None) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(self.features(texts, stated))[0], -30, 30)))


def _rows(x: Sparse, edges: np.ndarray, chosen: np.ndarray) -> Sparse:
    parts = [np.arange(edges[i], edges[i + 1]) for i in chosen]
    at = np.concatenate(parts)
    return Sparse(np.repeat(np.arange(len(chosen)), [len(p) for p in parts]), x.features[at], x.values[at], len(chosen))


def _in_chunks(sample: list[tuple]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Texts and stated lengths of a sample, a chunk at a time."""
    stated = pa.array([row[2] if len(row) > 2 else None for row in sample], pa.float64())
    whole = pa.record_batch([pa.array([row[0] for row in sample], pa.string()), stated], ["text", "stated"])
    for part in W.chunks(whole, "text"):
        yield part.column("text"), pc.fill_null(part.column("stated"), float("nan")).to_numpy(zero_copy_only=False)


def fit(sample: list[tuple], rank: int = RANK, epochs: int = EPOCHS, seed: int = 7, rate: float = 0.1, decay: float = 1e-5) -> Machine:
    """Logistic loss, adaptive gradient steps; ``sample`` has text, label and perhaps ``n_chars``.  With no sample, or one label only, the score is a smoothed prior."""
    size = (1 << WORD_BITS) + STRUCTURE
    rng = np.random.default_rng(seed)
    labels = np.array([row[1] for row in sample], float)
    machine = Machine(
        float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))),
        np.zeros(size),
        rng.normal(0, 0.02, (size, rank)),
        np.zeros(STRUCTURE),
        np.ones(STRUCTURE),
    )
    if len(set(labels.tolist())) < 2:
        machine.vectors[:] = 0
        return machine
    figures = [
        np.hstack([structure(texts, W.split(texts), W.split(texts, lower=True).hashes()), metadata(texts, stated)])
        for texts, stated in _in_chunks(sample)
    ]
    figures = np.concatenate(figures)
    machine.mean, machine.scale = figures.mean(axis=0), figures.std(axis=0) + 1e-3
    parts, base = [], 0
    for texts, stated in _in_chunks(sample):
        part = machine.features(texts, stated)
        order = np.argsort(part.rows, kind="stable")
        parts.append(((part.rows[order] + base).astype(np.int32), part.features[order].astype(np.int32), part.values[order]))
        base += part.size
    x = Sparse(*[np.concatenate(column) for column in zip(*parts)], base)
    edges = np.searchsorted(x.rows, np.arange(x.size + 1))
    seen = [np.full_like(machine.linear, 1e-6), np.full_like(machine.vectors, 1e-6)]
    for _ in range(epochs):
        shuffled = rng.permutation(x.size)
        for at in range(0, x.size, 64):
            chosen = shuffled[at : at + 64]
            part = _rows(x, edges, chosen)
            raw, sums = machine.raw(part)
            wrong = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[chosen]) / len(chosen)
            pull = wrong[part.rows] * part.values
            linear = np.bincount(part.features, pull, size) + decay * machine.linear
            inner = pull[:, None] * (sums[part.rows] - machine.vectors[part.features] * part.values[:, None])
            vectors = np.column_stack([np.bincount(part.features, inner[:, r], size) for r in range(rank)]) + decay * machine.vectors
            machine.bias -= rate * wrong.sum()
            for weights, step, total in ((machine.linear, linear, seen[0]), (machine.vectors, vectors, seen[1])):
                total += step**2
                weights -= rate * step / np.sqrt(total)
    return machine


def classify(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    threshold: float = THRESHOLD,
    modulus: int = MODULUS,
    remainder: int = HELD_OUT,
) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted``.

    ``score`` rises with the chance of label 1, and ``predicted`` is 1 from ``threshold`` on.  The text
    and ``n_chars``, if there is such a column, are the inputs.  A text that is NULL or empty gets the score of a text
    without words, a NULL ``n_chars`` says nothing; texts are read whole.  Rows are scored one by one, so
    repeated rows and NULL ids pass as they are, and an empty table gives no rows.  Other columns are not read.
    """
    stated = F.expr("try_cast(n_chars as double)") if "n_chars" in docs.columns else F.lit(None).cast("double")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", stated.alias("n_chars"))
    machine = docs.sparkSession.sparkContext.broadcast(fit(training_sample(read, labels, label, modulus, remainder, more=("n_chars",))))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                known = pc.fill_null(part.column("n_chars"), float("nan")).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(machine.value.score(part.column("text"), known))], ["doc_id", "score"])

    scored = read.mapInArrow(score, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), modulus, remainder).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
