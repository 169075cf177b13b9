"""Words of whole Arrow text columns as numpy arrays: spans and 64-bit hashes.

A word is a run of bytes other than space and ``\\x09``-``\\x0D``.  All work is
vectorised over a chunk of texts; a chunk holds about ``CHUNK_BYTES`` of text, or
one text that is longer by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 1 << 19
LONG = 64  # bytes of a word
#: Bytes between words: space and the ASCII white space.
SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True
#: Every ASCII byte that is neither letter nor digit.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: Odd bases of the byte polynomials, one per lane, each with its inverse modulo 2**64.
_BASES = [0x9E3779B97F4A7C15 | 5, 0xC2B2AE3D27D4EB4D | 5]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of unsigned 64-bit numbers over all bits (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd multipliers that follow from ``seed``."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def _powers_of(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if lane not in _powers or len(_powers[lane][0]) < n:
        size = max(n, CHUNK_BYTES)
        both = []
        for base in (_BASES[lane], pow(_BASES[lane], -1, 1 << 64)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            both.append(np.multiply.accumulate(factors))
        if size > 4 * CHUNK_BYTES:  # one very long text: not worth keeping
            return both[0], both[1]
        _powers[lane] = (both[0], both[1])
    return _powers[lane]


@dataclass
class Words:
    """Words of a chunk of texts, in order; ``first[i]:first[i + 1]`` are those of text ``i``."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self, lane: int = 0) -> np.ndarray:
        """One number per word, equal for equal words.

        Polynomials modulo 2**64 meet for long words of a certain pattern, so words beyond ``LONG`` bytes,
        which prose hardly has, are hashed one by one.
        """
        out = self.prefixes([len(self.data)], lane)[0]
        for i in np.flatnonzero(self.ends - self.starts > LONG).tolist():
            out[i] = xxhash.xxh3_64_intdigest(self.data[self.starts[i] : self.ends[i]], seed=lane + 1)
        return out

    def prefixes(self, lengths: list[int], lane: int = 0) -> list[np.ndarray]:
        """For each length, one number per word for its first so many bytes (or the whole word)."""
        power, inverse = _powers_of(lane, max(1, len(self.data)))
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * power[: len(self.data)], out=sums[1:])
        back = inverse[: max(1, len(self.data))][self.starts]
        out = []
        for length in lengths:
            ends = np.minimum(self.ends, self.starts + length)
            out.append(mix((sums[ends] - sums[self.starts]) * back + (ends - self.starts).astype(np.uint64)))
        return out

    def text_bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def split(texts: pa.Array, lower: bool = False, between: np.ndarray = SPACES) -> Words:
    """Words of ``texts`` (NULL: none); ``lower`` turns A-Z into a-z first, ``between`` marks the bytes outside words."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    if len(texts) == 0:
        empty = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint8), np.zeros(1, np.int64), empty, empty, np.zeros(1, np.int64))
    _, places, raw = texts.buffers()
    offsets = np.frombuffer(places, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        data = np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)
    inside = ~between[data]
    full = offsets[1:] > offsets[:-1]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][full]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[offsets[1:][full] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def chunks(batch: pa.RecordBatch, text: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``most`` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        done = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, done + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def grams(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A number for each run of ``n`` word hashes (fewer than ``n`` words: none)."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(size, np.uint64)
    for i, factor in enumerate(constants(n, seed)):
        out += words[i : i + size] * factor
    return mix(out)


def fits(words: Words, n: int) -> np.ndarray:
    """For each word: whether ``n`` words of its text start with it."""
    place = np.arange(len(words))
    return place + n <= np.repeat(words.first[1:], words.counts())


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (``np.minimum`` or ``np.maximum``) over each run of ``width`` values."""
    out, span = values, 1
    while span * 2 <= width:
        out = pick(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return pick(out[: len(out) - rest], out[rest:]) if rest else out
