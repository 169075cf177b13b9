"""Removal of passages that occur earlier in the corpus: a count-min prefilter, then exact groups.

1. Every partition counts windows in a count-min sketch.  A window is counted by
   its *anchor*, the smallest hash among its short word runs: neighbouring
   windows mostly share one, so the sketch takes a seventh of the entries, and
   each repetition of a window repeats its anchor, so the estimate is never too
   low.  Counters stop at two, all that is asked.  Partitions hand on the cells
   they touched, block by block; blocks are merged where they are shuffled to.
2. Windows whose every counter reached two are grouped by a 128-bit hash of
   their whole word sequence.  The group's smallest document keeps its first
   occurrence; only that reduction is shuffled, so a passage in a third of all
   documents is combined before it leaves a task.
3. Every document drops the words of its estimated-repeated windows, except the
   windows it is the keeper of.

The merged sketch has a fixed largest size (``max_sketch_bytes``) and is the
only thing broadcast.  Beyond that size more windows take the exact pass; the
result is the same.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roastery.llm import words as W

WINDOW = 20
ANCHOR = 8
DEPTH = 2
BLOCK_BITS = 22
BYTES_PER_ANCHOR = 40  # of text; only sizes the sketch
LAST = 2**63 - 1  # place of rows without an id: after all others


def sketch_bits(text_bytes: int, max_sketch_bytes: int) -> int:
    """Cells per row of the sketch as a power of two: four to eight for each expected anchor."""
    wanted = max(1 << 16, 4 * text_bytes // BYTES_PER_ANCHOR)
    return max(16, min(int(wanted - 1).bit_length(), (max_sketch_bytes * 8 // DEPTH).bit_length() - 1))


def _windows(words: W.Words, lane0: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Run hashes, the anchor of each window, and which windows lie within one text."""
    runs = W.grams(lane0, anchor, 11) | np.uint64(1)
    if len(words) < window:
        return runs, np.zeros(0, np.uint64), np.zeros(0, bool)
    anchors = W.sliding(runs, window - anchor + 1, np.minimum)
    return runs, anchors, W.fits(words, window)[: len(anchors)]


def _cells(anchors: np.ndarray, bits: int) -> list[np.ndarray]:
    mixed = W.mix(anchors)
    return [mixed >> np.uint64(64 - bits), mixed & np.uint64((1 << bits) - 1)]


def _count(window: int, anchor: int, bits: int):
    """Cells each partition touched: (depth, block, cells as gaps, which of them twice)."""
    block_bits = min(bits, BLOCK_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list[np.ndarray]] = [[], []]
        held = 0

        def merged():
            for depth, parts in enumerate(rows):
                if not parts:
                    continue
                cells, times = np.unique(np.concatenate(parts), return_counts=True)
                edges = np.searchsorted(cells, np.arange(0, (1 << bits) + 1, 1 << block_bits, dtype=np.uint64))
                for block in range(len(edges) - 1):
                    part = slice(edges[block], edges[block + 1])
                    if part.stop > part.start:
                        inner = (cells[part] - np.uint64(block << block_bits)).astype(np.uint32)
                        gaps = np.diff(inner, prepend=np.uint32(0)).astype(np.uint32)
                        yield (
                            (depth << 40) | block,
                            zlib.compress(gaps.tobytes(), 1),
                            zlib.compress(np.packbits(times[part] > 1).tobytes(), 1),
                        )
                parts.clear()

        def table(found):
            keys, cells, twice = zip(*found)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(cells, pa.binary()), pa.array(twice, pa.binary())],
                ["block", "cells", "twice"],
            )

        for batch in batches:
            for part in W.chunks(batch, "text"):
                words = W.split(part.column("text"))
                runs, anchors, whole = _windows(words, words.hashes(0), window, anchor)
                if not whole.any():
                    continue
                width = window - anchor + 1
                padded = np.zeros(len(anchors) + 2 * (width - 1), np.uint64)
                padded[width - 1 : width - 1 + len(anchors)] = np.where(whole, anchors, 0)
                chosen = runs[W.sliding(padded, width, np.maximum) == runs]
                for depth, cells in enumerate(_cells(chosen, bits)):
                    rows[depth].append(cells)
                held += len(chosen)
                if held > 4_000_000:  # bounded memory: hand on what there is
                    yield table(list(merged()))
                    held = 0
        if held:
            yield table(list(merged()))

    return count


def _merge(bits: int):
    """Saturating sums of the blocks that meet here, as bits for cells that reached two."""
    block_bits = min(bits, BLOCK_BITS)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[int, np.ndarray] = {}
        for batch in batches:
            for key, cells, twice in zip(*(batch.column(i).to_pylist() for i in range(3))):
                counter = counters.setdefault(key, np.zeros(1 << block_bits, np.uint8))
                at = np.cumsum(np.frombuffer(zlib.decompress(cells), np.uint32), dtype=np.int64)
                more = np.unpackbits(np.frombuffer(zlib.decompress(twice), np.uint8), count=len(at))
                counter[at] = np.minimum(2, counter[at] + 1 + more)
        for key, counter in counters.items():
            packed = zlib.compress(np.packbits(counter > 1).tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([packed], pa.binary())], ["block", "reached"])

    return merge


def repeated_cells(docs: DataFrame, window: int, anchor: int, bits: int) -> list[bytes]:
    """The merged sketch: for each row, one bit per cell that reached two.  Its size depends on ``bits`` alone."""
    block_bits = min(bits, BLOCK_BITS)
    parts = docs.select("text").mapInArrow(_count(window, anchor, bits), "block long, cells binary, twice binary")
    blocks = DEPTH << (bits - block_bits)
    merged = parts.repartition(blocks, "block").mapInArrow(_merge(bits), "block long, reached binary")
    sketch = [np.zeros((1 << bits) // 8, np.uint8) for _ in range(DEPTH)]
    size = (1 << block_bits) // 8
    for row in merged.toLocalIterator():
        block = row["block"] & ((1 << 40) - 1)
        sketch[row["block"] >> 40][block * size : (block + 1) * size] = np.frombuffer(zlib.decompress(row["reached"]), np.uint8)
    return [part.tobytes() for part in sketch]


def _estimated(sketch: list[bytes], anchors: np.ndarray, bits: int) -> np.ndarray:
    """Which anchors the sketch holds at least twice; too many, never too few."""
    out = np.ones(len(anchors), bool)
    for row, cells in zip(sketch, _cells(anchors, bits)):
        held = np.frombuffer(row, np.uint8)
        out &= (held[(cells >> np.uint64(3)).astype(np.int64)] >> (7 - (cells & np.uint64(7)).astype(np.uint8))) & 1 == 1
    return out


def _candidates(words: W.Words, sketch, window: int, anchor: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of estimated-repeated windows and their first hash."""
    lane0 = words.hashes(0)
    _, anchors, whole = _windows(words, lane0, window, anchor)
    at = np.flatnonzero(whole)
    at = at[_estimated(sketch, anchors[at], bits)] if len(at) else at
    return at, W.grams(lane0, window, 23)[at] if len(at) else np.zeros(0, np.uint64)


def _keys(sketch, window: int, anchor: int, bits: int):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                words = W.split(part.column("text"))
                at, one = _candidates(words, sketch.value, window, anchor, bits)
                if len(at):
                    two = W.grams(words.hashes(1), window, 37)[at]
                    ids = part.column("id").to_numpy(zero_copy_only=False)[words.owner()[at]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(ids, pa.int64())], ["h1", "h2", "id"]
                    )

    return keys


def _drop(sketch, window: int, anchor: int, bits: int, out_schema: pa.Schema):
    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                words = W.split(part.column("text"))
                at, hashes = _candidates(words, sketch.value, window, anchor, bits)
                edges = np.searchsorted(at, words.first)
                keepers = part.column("keeps")
                kept_texts, spans, removed = [], [], []
                for i in range(part.num_rows):
                    tokens = words.text_bytes(i).split()
                    mine = slice(edges[i], edges[i + 1])
                    starts = at[mine] - words.first[i]
                    if len(starts):
                        keeps = keepers[i].values.to_numpy().view(np.uint64) if keepers[i].is_valid else np.zeros(0, np.uint64)
                        distinct, where = np.unique(hashes[mine], return_index=True)
                        stays = np.zeros(len(starts), bool)
                        stays[where[np.isin(distinct, keeps)]] = True
                        starts = starts[~stays]
                    if len(starts):
                        change = np.zeros(len(tokens) + 1, np.int64)
                        change[starts] += 1
                        change[starts + window] -= 1
                        covered = np.cumsum(change)[:-1] > 0
                        edge = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
                        spans.append([{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
                        removed.append(int(covered.sum()))
                        tokens = [t for t, gone in zip(tokens, covered.tolist()) if not gone]
                    else:
                        spans.append([])
                        removed.append(0)
                    kept_texts.append(b" ".join(tokens))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(words.counts(), pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(kept_texts, pa.binary()).cast(pa.string()),
                        pa.array(spans, out_schema.field("removed").type),
                    ],
                    schema=out_schema,
                )

    return drop


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
    max_sketch_bytes: int = 64 << 20,
) -> DataFrame:
    """Per document: ``doc_id, n_words, n_removed, kept_text, removed``.

    A word goes if a window of ``window`` consecutive words that covers it starts
    earlier as well (smaller id, or same document and earlier start); windows are
    judged on the input.  ``kept_text`` joins the words that stay by one space and
    ``removed`` has word spans ``[start, end)``.  Texts of fewer words stay whole.

    NULL text: no words, empty ``kept_text``.  NULL ids come after all others and,
    like rows with one and the same id, count as one document whose every row
    keeps its first occurrence, so repeated rows give equal results.  Other columns of
    ``docs`` are not read, whatever their names.
    """
    anchor = min(anchor, window)
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    texts = texts.withColumn("id", F.coalesce("doc_id", F.lit(LAST)))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = sketch_bits(size, max_sketch_bytes)
    sketch = spark.sparkContext.broadcast(repeated_cells(texts, window, anchor, bits))

    candidates = texts.select("id", "text").mapInArrow(_keys(sketch, window, anchor, bits), "h1 long, h2 long, id long")
    keepers = candidates.groupBy("h1", "h2").agg(F.min("id").alias("id"))
    keeps = keepers.groupBy("id").agg(F.collect_list("h1").alias("keeps"))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("removed", span)]
    )
    return (
        texts.join(keeps, "id", "left")
        .select("doc_id", "text", "keeps")
        .mapInArrow(
            _drop(sketch, window, anchor, bits, schema),
            "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start:int,end:int>>",
        )
    )
