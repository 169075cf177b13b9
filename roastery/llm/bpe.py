"""Byte-level BPE: texts to token ids and back, as the public tokenizer file defines them.

A piece of text becomes a doubly linked list of byte symbols.  A priority queue
holds the merges its neighbours allow, by rank and place; each merge taken ties
two symbols into one and offers its new neighbours, and entries whose symbols have
changed meanwhile are skipped as stale.  Ids decode by concatenating the byte
strings of the vocabulary.

Work is per row: no shuffle.  The tokenizer's file (a few MB at any corpus size) is
read once on the driver and broadcast.  Each Python worker keeps the ids of pieces
it has met, up to ``CACHE`` of them.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roastery.llm import words as W

# Fixed value: how byte-level tokenizers cut text into pieces before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE = 400_000
CACHED_CHARS = 48


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if visible in Latin-1, else the next free one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in visible)
    names = {b: chr(256 + i) for i, b in enumerate(hidden)} | {b: chr(b) for b in visible}
    return [names[b] for b in range(256)]


class Tokenizer:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, definition: str):
        told = json.loads(definition)
        ids = told["model"]["vocab"]
        symbols = byte_symbols()
        self.of_byte = [ids[s] for s in symbols]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(told["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])
        special = {t["content"]: t["id"] for t in told.get("added_tokens", [])}
        size = max([*ids.values(), *special.values()]) + 1
        byte_of = {s: b for b, s in enumerate(symbols)}
        self.strings = [b""] * size
        for token, i in ids.items():
            self.strings[i] = bytes(byte_of[c] for c in token)
        for token, i in special.items():
            self.strings[i] = token.encode()
        self.special = {token: np.uint32(i).tobytes() for token, i in special.items()}
        self.around = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.pieces = regex.compile(PIECES)
        self.known = _Known(self)
        self.cache = CACHE

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        symbol = [self.of_byte[b] for b in piece]
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = self.merges
        queue = []
        for i in range(n - 1):
            found = merges.get((symbol[i], symbol[i + 1]))
            if found:
                queue.append((found[0], i, symbol[i], symbol[i + 1], found[1]))
        heapify(queue)
        while queue:
            _, i, left, right, new = heappop(queue)
            j = after[i]
            if symbol[i] != left or j >= n or symbol[j] != right:
                continue  # stale
            symbol[i], symbol[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = merges.get((new, symbol[k]))
                if found:
                    heappush(queue, (found[0], i, new, symbol[k], found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get((symbol[h], new))
                if found:
                    heappush(queue, (found[0], h, symbol[h], new, found[1]))
        return [s for s in symbol if s >= 0]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as little-endian unsigned 32-bit numbers."""
        if len(self.known) > self.cache:
            self.known.clear()
        known, find = self.known.__getitem__, self.pieces.findall
        if self.around is None or not any(token in text for token in self.special):
            return b"".join(map(known, find(text)))
        parts = self.around.split(text)
        return b"".join(self.special[part] if i % 2 else b"".join(map(known, find(part))) for i, part in enumerate(parts))

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; bytes that are not UTF-8 become the replacement character, ids beyond the vocabulary nothing."""
        if len(ids) and int(ids.max()) >= len(self.strings):
            ids = ids[ids < len(self.strings)]
        return b"".join(map(self.strings.__getitem__, ids.tolist())).decode("utf-8", "replace")


class _Known(dict):
    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.merge = tokenizer.merge

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.merge(piece.encode()), "<u4").tobytes()
        if len(piece) <= CACHED_CHARS:
            self[piece] = ids
        return ids


_loaded: dict[str, Tokenizer] = {}


def _tokenizer(definition: str) -> Tokenizer:
    """One per definition and Python worker."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Tokenizer(definition)
    return _loaded[key]


def _encode(definition, decoded: bool, cache: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(definition.value)
        tokenizer.cache = cache
        for batch in batches:
            for part in W.chunks(batch, "text"):
                ids = [tokenizer.encode(text or "") for text in part.column("text").to_pylist()]
                columns = [part.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
                names = ["doc_id", "n_tokens", "ids"]
                if decoded:
                    columns.append(pa.array([tokenizer.decode(np.frombuffer(i, "<u4")) for i in ids], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names)

    return encode


def _definition(df: DataFrame, path: str):
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", decoded: bool = False, cache: int = CACHE) -> DataFrame:
    """Per document: ``doc_id, n_tokens, ids`` and, if asked, ``decoded``, the text that the ids give back.

    ``tokenizer`` is the path of a byte-level BPE definition on the driver.  ``ids`` are
    little-endian unsigned 32-bit numbers side by side, as token shards hold them;
    special tokens spelled out in a text get their own id, none is added, and
    nothing is truncated or padded.  NULL and empty texts have no ids and decode to
    an empty text.  Every row is encoded by itself, so repeated rows and NULL ids
    pass as they are; other columns are not read, whatever their names.  A Python worker
    remembers the ids of ``cache`` pieces at most, about 200 bytes each, also between tasks.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    schema = "doc_id long, n_tokens long, ids binary" + (", decoded string" if decoded else "")
    return texts.mapInArrow(_encode(_definition(docs, tokenizer), decoded, cache), schema)


def _decode(definition):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(definition.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [tokenizer.decode(np.frombuffer(ids or b"", "<u4")) for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return decode


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, text`` from rows that ``encode`` made; NULL ids give an empty text."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(_definition(encoded, tokenizer)), "doc_id long, text string")
