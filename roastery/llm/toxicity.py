"""Toxic spans by a linear-chain conditional random field; document scores from its marginals.

Each token is tagged toxic or not.  A token's features are its letters, its beginnings
of several lengths and its neighbours, hashed; the chain adds the ties between
neighbouring tags.  Forward-backward marginals give each token's chance of being
toxic, neighbouring likely tokens make a span, and the expected number of toxic
tokens and the surest of them make the document's score.

Labels exist for documents only.  Tokens are labelled from them: in a toxic document,
those whose form, or beginning, is found in many toxic and hardly any other
documents, counting each context once so that copies of one document do not make
its rare words look telling.

The field is fitted on a bounded sample (``labelled``), its token weights and ties on all toxic
texts of it and as many calm ones drawn by a hash of the text, and broadcast; every document is
then tagged whole in one pass without a shuffle.  The chain of a whole chunk of documents
runs as one product of two-by-two matrices, which a document's first token resets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roastery.llm import words as W
from roastery.llm.labelled import held_out, training_sample

BITS = 18
BEGINNINGS = [4, 5, 6, 8]  # bytes
THRESHOLD = 0.7
SPAN_AT = 0.5  # marginal from which a token belongs to a span
MODULUS, HELD_OUT = 3, 1
STEPS = 60
SLICES = 4  # parts of a kind's forms that are counted at once


@dataclass
class Tokens:
    """Runs of letters and digits of a chunk, with the hash of each token and of its beginnings."""

    words: W.Words
    forms: list[np.ndarray]  # whole token first

    @classmethod
    def of(cls, texts: pa.Array) -> Tokens:
        words = W.split(texts, lower=True, between=W.MARKS)
        lengths = words.ends - words.starts
        forms = words.prefixes([len(words.data), *BEGINNINGS])
        # A token shorter than a beginning has its whole form there once more.
        kinds = W.constants(len(forms), 31)
        return cls(words, [f * k if i == 0 else np.where(lengths > BEGINNINGS[i - 1], f * k, 0) for i, (f, k) in enumerate(zip(forms, kinds))])

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the token before and after each, 0 at the ends of a text."""
        whole, first = self.forms[0], self.words.first
        before, after = np.zeros(len(whole), np.uint64), np.zeros(len(whole), np.uint64)
        before[1:], after[:-1] = whole[:-1], whole[1:]
        full = first[1:] > first[:-1]
        before[first[:-1][full]] = 0
        after[first[1:][full] - 1] = 0
        return before, after

    def features(self) -> np.ndarray:
        """Feature numbers, a row for each kind; 0 is no feature."""
        before, after = self.neighbours()
        a, b = W.constants(2, 33)
        hashed = np.stack([*self.forms, before * a, after * b])
        return np.where(hashed == 0, 0, 1 + (W.mix(hashed) >> np.uint64(64 - BITS)).astype(np.int64))


def _chain(steps: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Row vectors ``start @ steps[0] @ ... @ steps[t]``, scaled to sum one, for every ``t``.

    ``steps`` has the four entries of each matrix as rows.  Equal blocks advance side by
    side; then each block's start follows from the block before.
    """
    n = steps.shape[1]
    length = max(1, int(np.sqrt(n)))
    blocks = -(-n // length)
    padded = np.empty((4, blocks * length))
    padded[:, :n] = steps
    padded[:, n:] = np.array([1.0, 0.0, 0.0, 1.0])[:, None]
    # Places of a block run along the first axis, so that a step reads whole rows.
    padded = np.ascontiguousarray(padded.reshape(4, blocks, length).transpose(2, 0, 1))
    products = np.empty_like(padded)
    m = products[0] = padded[0]
    for t in range(1, length):
        q = padded[t]
        m = np.stack([m[0] * q[0] + m[1] * q[2], m[0] * q[1] + m[1] * q[3], m[2] * q[0] + m[3] * q[2], m[2] * q[1] + m[3] * q[3]])
        m /= m.sum(axis=0)
        products[t] = m
    starts = np.empty((2, blocks))
    x, y = float(start[0]), float(start[1])
    for i, (a, b, c, d) in enumerate(products[-1].T.tolist()):
        starts[:, i] = x, y
        x, y = x * a + y * c, x * b + y * d
        x, y = x / (x + y), y / (x + y)
    out = np.stack([starts[0] * products[:, 0] + starts[1] * products[:, 2], starts[0] * products[:, 1] + starts[1] * products[:, 3]])
    out = out.transpose(0, 2, 1).reshape(2, -1)[:, :n]
    return out / out.sum(axis=0)


@dataclass
class Field:
    """Weights for the toxic tag of each feature, its bias, tag ties, and the document's logistic function."""

    weights: np.ndarray
    bias: float
    first: np.ndarray  # log weight of each tag at the start of a text
    ties: np.ndarray  # log weight of tag pairs
    document: np.ndarray

    def marginals(self, features: np.ndarray, starts: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Chance of the toxic tag of each token and, if asked, the expected tag pairs; ``starts`` are first tokens."""
        n = features.shape[1]
        if not n:
            return np.zeros(0), np.zeros((2, 2))
        emit = np.exp(np.clip(self.bias + sum(self.weights[f] for f in features), -30, 30))
        ties, first = np.exp(self.ties), np.exp(self.first)
        steps = np.stack([np.full(n, ties[0, 0]), ties[0, 1] * emit, np.full(n, ties[1, 0]), ties[1, 1] * emit])
        steps[0, starts] = steps[2, starts] = first[0]
        steps[1, starts] = steps[3, starts] = first[1] * emit[starts]
        forward = _chain(steps, np.ones(2) / 2)
        backward = np.ones((2, n))
        if n > 1:  # the same chain on transposed matrices, from the end
            backward[:, :-1] = _chain(steps[[0, 2, 1, 3], :0:-1], np.ones(2))[:, ::-1]
        both = forward * backward
        chance = both[1] / both.sum(axis=0)
        if not pairs:
            return chance, None
        inside = np.ones(n, bool)
        inside[starts] = False
        inside = np.flatnonzero(inside)
        joint = np.stack([forward[i // 2, inside - 1] * steps[i, inside] * backward[i % 2, inside] for i in range(4)])
        return chance, (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)

    def tag(self, texts: pa.Array) -> tuple[Tokens, np.ndarray]:
        tokens = Tokens.of(texts)
        first = tokens.words.first
        return tokens, self.marginals(tokens.features(), first[:-1][first[1:] > first[:-1]])[0]

    def score(self, tokens: Tokens, chance: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(figures(tokens, chance) @ self.document, -30, 30)))


def figures(tokens: Tokens, chance: np.ndarray) -> np.ndarray:
    """Per document: one, the expected number of toxic tokens, and how sure the surest is."""
    n = len(tokens.words.first) - 1
    owner = tokens.words.owner()
    most = np.zeros(n)
    np.maximum.at(most, owner, chance)
    return np.column_stack([np.ones(n), np.log1p(np.bincount(owner, chance, n)), most])


@dataclass
class Sample:
    """The tokens of all sampled texts: their forms, contexts and texts.  Made a chunk of texts at a time."""

    texts: list[pa.Array]
    forms: np.ndarray  # a row for each kind
    around: np.ndarray  # hash of a token's neighbours
    owner: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Sample:
        whole = pa.record_batch([pa.array(texts, pa.string())], ["text"])
        chunks = [part.column("text") for part in W.chunks(whole, "text")]
        return cls.join(chunks, (Tokens.of(chunk) for chunk in chunks))

    @classmethod
    def join(cls, chunks: list[pa.Array], parts: Iterable[Tokens]) -> Sample:
        forms, around, owner, at = [], [], [], 0
        a, b = W.constants(2, 35)
        for tokens in parts:
            before, after = tokens.neighbours()
            forms.append(np.stack(tokens.forms))
            around.append(W.mix(before * a + after * b))
            owner.append((tokens.words.owner() + at).astype(np.int32))
            at += len(tokens.words.first) - 1
        return cls(chunks, np.concatenate(forms, axis=1), np.concatenate(around), np.concatenate(owner))


def token_labels(tokens: Tokens | Sample, toxic: np.ndarray) -> np.ndarray:
    """Which tokens are toxic, given which documents are."""
    sample = tokens if isinstance(tokens, Sample) else Sample.join([], [tokens])
    owner = sample.owner
    of_toxic = toxic[owner]
    tables = []  # of each kind and share of its forms; no form is in two
    for kind, form in enumerate(sample.forms):
        share = np.where(form != 0, form % np.uint64(SLICES), SLICES).astype(np.uint8)
        for slice_ in range(SLICES):
            real = np.flatnonzero(share == slice_)
            # Distinct (form, context), with their class; then distinct (form, document).
            contexts = _distinct(form[real], sample.around[real], of_toxic[real])
            documents = _distinct(form[real], owner[real].astype(np.uint64), of_toxic[real])
            names, place = np.unique(np.concatenate([contexts[0], documents[0]]), return_inverse=True)
            in_contexts, in_documents = place[: len(contexts[0])], place[len(contexts[0]) :]
            count = lambda at, flag: np.bincount(at, flag, len(names)).astype(np.int32)
            seen = np.minimum(count(in_contexts, None), count(in_documents, None))
            yes, docs = count(in_contexts, contexts[1]), count(in_documents, documents[1])
            tables.append((kind, names, yes, count(in_contexts, ~contexts[1]), docs, seen))
    common = np.concatenate([seen for *_, seen in tables])
    least = evidence(common, toxic.mean())
    marked = np.zeros(len(owner), bool)
    while True:
        for kind, names, yes, no, docs, _ in tables:
            marked |= _among(sample.forms[kind], names[(np.minimum(yes, docs) >= least) & (no <= 0.02 * yes)])
        # Too few documents for evidence: the forms that come closest to it, since without any all documents score alike.
        if least == 2 or (marked & of_toxic).any():
            break
        least -= 1
    # Toxic documents not reached so: the form without other contexts that reaches most of them, and again.
    while True:
        missed = toxic.copy()
        missed[owner[marked & of_toxic]] = False
        if not missed.any():
            break
        least = evidence(common, missed.sum() / (missed.sum() + (~toxic).sum()))
        best = (0, 0, 0)
        for kind, names, yes, no, docs, _ in tables:
            form = sample.forms[kind]
            at = missed[owner] & _among(form, names[(np.minimum(yes, docs) >= least) & (no == 0)])
            found = np.unique(np.stack([form[at], owner[at].astype(np.uint64)], 1), axis=0)[:, 0]
            if len(found):
                reached, docs = np.unique(found, return_counts=True)
                best = max(best, (int(docs.max()), kind, reached[docs.argmax()]))
        if best[0] < least:
            break
        marked |= sample.forms[best[1]] == best[2]
    return marked & of_toxic


def _among(values: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which values are among ``names``, which are in order."""
    if not len(names):
        return np.zeros(len(values), bool)
    return names[np.minimum(np.searchsorted(names, values), len(names) - 1)] == values


def evidence(seen: np.ndarray, share: float) -> int:
    """How many documents must have a form, all of them of a class with this ``share``, for chance to bring about no more than half a form."""
    times, forms = np.unique(seen, return_counts=True)
    least = 2
    while (forms * share ** times.astype(float))[times >= least].sum() > 0.5:
        least += 1
    return least


def _distinct(form: np.ndarray, with_what: np.ndarray, flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = W.mix(form ^ W.mix(with_what + np.uint64(1))) ^ flag.astype(np.uint64)
    _, at = np.unique(key, return_index=True)
    return form[at], flag[at]


def fit(sample: list[tuple[str, int]], steps: int = STEPS, rate: float = 1.0, decay: float = 0.05) -> Field:
    """Maximum likelihood of the token labels, then of the document labels.  With no sample, or one label only, the score is a smoothed prior."""
    labels = np.array([y for _, y in sample], bool)
    prior = float(np.log((labels.sum() + 1) / ((~labels).sum() + 1)))
    field = Field(np.zeros((1 << BITS) + 1), -8.0, np.zeros(2), np.zeros((2, 2)), np.array([prior, 0.0, 0.0]))
    if labels.all() or not labels.any():
        return field
    tokens = Sample.of([t for t, *_ in sample])
    marks = token_labels(tokens, labels)
    # All toxic documents and as many others teach the chain, these in the order of a hash: the sample comes by id.
    calm = np.array(sorted(np.flatnonzero(~labels).tolist(), key=lambda i: hashlib.md5(sample[i][0].encode()).digest()))[: int(labels.sum())]
    taught = np.isin(np.arange(len(labels)), calm) | labels
    owner, texts = tokens.owner, tokens.texts
    del tokens
    lessons = list(_lessons(texts, owner, taught, marks))
    seen_pairs = sum(np.bincount(tags[at - 1] * 2 + tags[at], minlength=4) for *_, tags, at in lessons).reshape(2, 2)
    seen_first = sum(np.bincount(tags[starts], minlength=2) for _, starts, tags, _ in lessons)
    # Steps start damped, so that frequent harmless features do not run ahead of the telling ones.
    damp = 1 + 0.4 * float(sum(tags.sum() for *_, tags, _ in lessons))
    totals = [np.full_like(field.weights, damp), damp, np.full(2, damp), np.full((2, 2), damp)]
    for _ in range(steps):
        pulls = [decay * field.weights, 0.0, -seen_first.astype(float), -seen_pairs.astype(float)]
        for features, starts, tags, _ in lessons:
            chance, pairs = field.marginals(features, starts, pairs=True)
            wrong = chance - tags
            pulls[0] += np.bincount(features.ravel(), np.tile(wrong, len(features)), len(field.weights))
            pulls[1] += wrong.sum()
            pulls[2] += np.array([(1 - chance[starts]).sum(), chance[starts].sum()])
            pulls[3] += pairs
        pulls[0][0] = 0
        for i, pull in enumerate(pulls):
            totals[i] = totals[i] + pull**2
        field.weights -= rate * pulls[0] / np.sqrt(totals[0])
        field.bias -= rate * float(pulls[1] / np.sqrt(totals[1]))
        field.first -= rate * pulls[2] / np.sqrt(totals[2])
        field.ties -= rate * pulls[3] / np.sqrt(totals[3])
    del lessons
    shown = np.concatenate([figures(*field.tag(chunk)) for chunk in texts])
    field.document = _logistic(shown, labels, field.document)
    return field


def _logistic(shown: np.ndarray, labels: np.ndarray, start: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights of the document's logistic function, slopes with a little decay, by damped Newton steps.

    Labels that the figures all but separate flatten the curve, and whole steps overshoot then; so a step
    is halved until the loss, which is convex, falls.
    """
    decay = 0.1 * np.array([0, 1, 1])
    loss = lambda w: np.logaddexp(0, shown @ w).sum() - (shown[labels] @ w).sum() + (decay * w * w).sum() / 2
    weights, now = start, loss(start)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(shown @ weights, -30, 30)))
        pull = shown.T @ (p - labels) + decay * weights
        curve = (shown * (p * (1 - p) + 1e-6)[:, None]).T @ shown + np.diag([1e-4, 0.1, 0.1])
        step = np.linalg.solve(curve, pull)
        gain, size = float(pull @ step), 1.0
        while size > 1e-6 and not loss(weights - size * step) <= now - 1e-4 * size * gain:
            size /= 2
        if gain < 1e-20 or size <= 1e-6:
            break
        weights = weights - size * step
        now = loss(weights)
    return weights


def _lessons(texts: list[pa.Array], owner: np.ndarray, taught: np.ndarray, marks: np.ndarray) -> Iterator[tuple]:
    """Chunk by chunk, of the documents that teach: features, first tokens, tags, and the tokens that follow another."""
    token = 0
    for chunk in texts:
        tokens = Tokens.of(chunk)
        end = token + len(tokens.words)
        used = taught[owner[token:end]]
        if used.any():
            own = owner[token:end][used]
            first = np.diff(own, prepend=-1) != 0
            yield tokens.features()[:, used].astype(np.int32), np.flatnonzero(first), marks[token:end][used].astype(np.int8), np.flatnonzero(~first)
        token = end


def spans(tokens: Tokens, chance: np.ndarray, least: float) -> list[list[dict]]:
    """Runs of likely toxic tokens of each document, in code points ``[start, end)``."""
    words = tokens.words
    points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    out: list[list[dict]] = [[] for _ in range(len(words.first) - 1)]
    owner = words.owner()
    for at in np.flatnonzero(chance >= least).tolist():
        doc = int(owner[at])
        base = points[words.offsets[doc]]
        start, end = int(points[words.starts[at]] - base), int(points[words.ends[at]] - base)
        own = out[doc]
        if own and own[-1]["last"] == at - 1:
            own[-1].update(end=end, last=at, chance=max(own[-1]["chance"], float(chance[at])))
        else:
            own.append({"start": start, "end": end, "chance": float(chance[at]), "last": at})
    return [[{k: s[k] for k in ("start", "end", "chance")} for s in own] for own in out]


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    threshold: float = THRESHOLD,
    span_at: float = SPAN_AT,
    modulus: int = MODULUS,
    remainder: int = HELD_OUT,
) -> DataFrame:
    """Per document: ``doc_id, held_out, score, predicted, spans``.

    ``score`` rises with the chance of label 1, ``predicted`` is 1 from ``threshold`` on, and ``spans``
    gives the offending places in code points.  Only the text is an input.  NULL and empty
    texts have no tokens, no spans and the score of a text without toxic tokens; rows
    are scored one by one, so repeated rows and NULL ids pass as they are, and an empty table gives
    no rows.  Columns other than ``doc_id`` and ``text`` are not read.
    """
    field = docs.sparkSession.sparkContext.broadcast(fit(training_sample(docs, labels, label, modulus, remainder)))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("chance", pa.float64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                tokens, chance = field.value.tag(part.column("text"))
                columns = [part.column("doc_id"), pa.array(field.value.score(tokens, chance)), pa.array(spans(tokens, chance, span_at), span)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "spans"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        score, "doc_id long, score double, spans array<struct<start:int,end:int,chance:double>>"
    )
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), modulus, remainder).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "spans",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD, modulus: int = MODULUS, remainder: int = HELD_OUT) -> DataFrame:
    """``docs`` without the rows that ``toxicity`` predicts toxic; all columns stay, whatever their names."""
    field = docs.sparkSession.sparkContext.broadcast(fit(training_sample(docs, labels, label, modulus, remainder)))
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index("text")]

    def calm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, text):
                yield part.filter(pa.array(field.value.score(*field.value.tag(part.column(text))) < threshold))

    numbered = docs.toDF(*names)
    return numbered.mapInArrow(calm, numbered.schema).toDF(*docs.columns)
