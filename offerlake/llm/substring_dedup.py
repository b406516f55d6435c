"""Substring deduplication: remove every word covered by a window of ``window`` words that
starts anywhere else too (another document or the same one).

Method.  A count-min sketch over all windows finds the windows that may repeat; only those
are grouped exactly, and none is lost:

1. *Partition sketches.*  A window is sketched by its minimiser, the smallest hash among
   its ``GRAM``-word grams.  Equal windows at two starts select the same value at two gram
   positions, so counting every selected gram position overestimates the window's count
   and can never report a repeated window as single -- with one count per ~14 windows.
   Each task keeps saturating counts of its cells and emits them per sketch segment.
2. *Merge.*  One task at a time streams a segment's blobs into 2^20 counters and emits two
   bits of them: "at least two" for each cell, "at least ``HOT``" for each ``HOT_SPAN`` cells.
   The merged sketch holds ``DEPTH`` rows of both; its size follows the corpus up to
   ``max_sketch_bytes`` and a 16th more (the proven bound of what is broadcast).  Beyond that
   size more windows pass and more are dealt one by one; the result stays exact.
3. *Exact groups.*  Windows whose minimiser is estimated repeated carry 128-bit hashes of
   complete word sequence to the task of their minimiser, one row per run of windows
   with the same minimiser.  Minimisers whose estimate is ``HOT`` or more (all that occur that
   often in the corpus are among them, however few a batch holds) deal each window by its own
   hash instead: a frequent line amid different texts spreads over all tasks, equal windows
   still meet, and a task holds fewer than ``HOT`` occurrences of any value it was dealt by
   minimiser.  Windows that repeat inside one batch are settled there and
   send a single representative, so a passage found in a third of all documents costs one
   row per batch, not one per document.
4. Repeated starts return to their documents, whose words are then removed.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  Defined cases: NULL or empty text has no
words (n_words 0, SHA-256 of the empty string); texts shorter than the window are kept
whole; repeated rows are copies like any other, so all their windows repeat; rows are told
apart by id and text only, which is enough because equal rows get equal results; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.llm.common import map_batches, pick, prepare, row_key
from offerlake.llm.textnp import byte_values, grams, mix, non_space, sliding, words

WINDOW = 35
GRAM = 8
DEPTH = 2
SEGMENT_BITS = 20
MAX_SKETCH_BYTES = 64 << 20
FLUSH = 1 << 20
COUNT_BITS = 32 - SEGMENT_BITS
HOT = 1024
HOT_SPAN = 16
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_FLAG = np.uint32(1 << 31)


class Windows:
    """Windows of a chunk: ``ok`` (starts), ``low`` (each start's minimiser), ``picked``
    (values of the selected gram positions)."""

    def __init__(self, w, window: int):
        n = len(w)
        gram = min(GRAM, window)
        self.size = max(n - window + 1, 0)
        if not self.size:
            self.ok, self.low, self.picked = np.zeros(0, bool), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
            return
        g = mix(grams(w.hash, gram), 3) | np.uint64(1)
        span = window - gram + 1
        self.low = sliding(g, span, np.minimum)
        self.ok = w.doc[:self.size] == w.doc[window - 1:]
        self.low[~self.ok] = 0
        padded = np.zeros(self.size + 2 * (span - 1), np.uint64)
        padded[span - 1:span - 1 + self.size] = self.low
        self.picked = g[g == sliding(padded, span, np.maximum)]


def _cells(values: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(values, 101 + row) >> np.uint64(64 - bits)).astype(np.int64)


def _sketcher(window: int, bits: int):
    def blobs(values: np.ndarray) -> Iterator[tuple[int, bytes]]:
        for row in range(DEPTH):
            cell, count = np.unique(_cells(values, row, bits), return_counts=True)
            count = np.minimum(count, (1 << COUNT_BITS) - 1)
            packed = ((cell & ((1 << SEGMENT_BITS) - 1)) << COUNT_BITS | count).astype(np.uint32)
            segment = (cell >> SEGMENT_BITS) * DEPTH + row
            at = np.flatnonzero(np.diff(segment, prepend=-1))
            for a, b in zip(at, np.append(at[1:], len(segment))):
                yield int(segment[a]), packed[a:b].tobytes()

    def batch(values: list[np.ndarray]) -> pa.RecordBatch:
        made = list(blobs(np.concatenate(values)))
        return pa.RecordBatch.from_arrays([pa.array([s for s, _ in made], pa.int64()),
                                           pa.array([b for _, b in made], pa.binary())], ["segment", "cells"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_word, values = non_space(), byte_values(False)
        held, n = [], 0
        for b in batches:
            for _, _, w in words(b.column("text"), is_word, values):
                held.append(Windows(w, window).picked)
                n += len(held[-1])
                if n >= FLUSH:
                    yield batch(held)
                    held, n = [], 0
        if n:
            yield batch(held)
    return run


def _merge_segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by segment; one segment's counters are held at a time."""
    current, counts = None, None

    def done() -> pa.RecordBatch:
        hot = (counts >= HOT).reshape(-1, HOT_SPAN).any(axis=1)
        return pa.RecordBatch.from_arrays(
            [pa.array([current], pa.int64()), pa.array([np.packbits(counts >= 2).tobytes()], pa.binary()),
             pa.array([np.packbits(hot).tobytes()], pa.binary())], ["segment", "bits", "hot"])

    for b in batches:
        for segment, cells in zip(b.column("segment").to_pylist(), b.column("cells")):
            if segment != current:
                if current is not None:
                    yield done()
                current, counts = segment, np.zeros(1 << SEGMENT_BITS, np.uint16)
            packed = np.frombuffer(cells.as_buffer(), np.uint32)
            cell, count = packed >> COUNT_BITS, packed & ((1 << COUNT_BITS) - 1)
            counts[cell] = np.minimum(counts[cell] + count, HOT)
    if current is not None:
        yield done()


def build_sketch(rows: DataFrame, spark: SparkSession, window: int, bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The merged sketch, two packed bit arrays per sketch row: "count of two or more" by
    cell and "count of ``HOT`` or more" by ``HOT_SPAN`` cells."""
    parts = map_batches(rows.select("text"), _sketcher(window, bits), "segment bigint, cells binary")
    merged = map_batches(parts.repartition("segment").sortWithinPartitions("segment"), _merge_segments,
                         "segment bigint, bits binary, hot binary")
    sketch = [np.zeros(1 << (bits - 3), np.uint8) for _ in range(DEPTH)]
    hot = [np.zeros(len(x) // HOT_SPAN, np.uint8) for x in sketch]
    for r in merged.toLocalIterator():  # max_sketch_bytes and a 16th in all
        at, row = divmod(r["segment"], DEPTH)
        for whole, part in ((sketch[row], r["bits"]), (hot[row], r["hot"])):
            size = min(len(part), len(whole))
            whole[at * size:(at + 1) * size] = np.frombuffer(part, np.uint8)[:size]
    return sketch, hot


def _in_sketch(values: np.ndarray, packed_rows: list[np.ndarray], bits: int, span: int = 1) -> np.ndarray:
    """Whether the bit of a value (of its ``span`` cells) is set in every sketch row."""
    out = np.ones(len(values), bool)
    for row, packed in enumerate(packed_rows):
        cell = _cells(values, row, bits) // span
        out &= (packed[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)
    return out


def _repeats(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: does its 128-bit hash occur twice; is it the first occurrence."""
    order = np.lexsort((h2, h1))
    a, b = h1[order], h2[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    group = np.cumsum(new) - 1
    many = (np.bincount(group, minlength=1) > 1)[group] if len(a) else new
    repeated, first = np.zeros(len(a), bool), np.zeros(len(a), bool)
    repeated[order], first[order] = many, new
    return repeated, first


_FOUND = "dealt bigint, doc binary, starts binary, hashes binary"


def _candidates(window: int, bits: int, sketch):
    """Rows with hashes: windows for the exact pass, dealt by minimiser (by their own hash if
    that is hot); without: starts already settled, which only pass through."""
    def settle(held: list[tuple], hot: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        low, doc, start, h1, h2 = (np.concatenate([h[i] for h in held]) for i in range(5))
        keys = [k for h in held for k in h[5]]
        repeated, first = _repeats(h1, h2)
        rows: list[tuple] = []
        at = np.flatnonzero(repeated)
        cut = np.flatnonzero(np.diff(doc[at], prepend=-1))
        for a, b in zip(cut, np.append(cut[1:], len(at))):
            key = keys[doc[at[a]]]
            rows.append((int.from_bytes(key[:8], "little", signed=True), key, start[at[a:b]].astype(np.uint32).tobytes(), None))
        send = np.flatnonzero(~repeated | first)
        flagged = start[send].astype(np.uint32) | np.where(repeated[send], _FLAG, np.uint32(0))
        both = np.stack([h1[send], h2[send]], 1)
        dealt, doc = np.where(_in_sketch(low[send], hot, bits, HOT_SPAN), h1[send], low[send]), doc[send]
        new = np.ones(len(send), bool)
        new[1:] = (dealt[1:] != dealt[:-1]) | (doc[1:] != doc[:-1])
        cut = np.flatnonzero(new)
        for a, b in zip(cut, np.append(cut[1:], len(send))):
            rows.append((int(dealt[a].astype(np.int64)), keys[doc[a]], flagged[a:b].tobytes(), both[a:b].tobytes()))
        for a in range(0, len(rows), 8192):
            part = list(zip(*rows[a:a + 8192]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[0], pa.int64()), *[pa.array(c, pa.binary()) for c in part[1:]]],
                ["dealt", "doc", "starts", "hashes"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_word, values = non_space(), byte_values(False)
        bitmap, hot = sketch.value
        held, n, base = [], 0, 0
        for batch in batches:
            keys = batch.column("doc")
            for a, b, w in words(batch.column("text"), is_word, values):
                found = Windows(w, window)
                at = np.flatnonzero(found.ok)
                # Estimate once per run of starts with one minimiser.
                run_at = np.flatnonzero(np.diff(found.low[at], prepend=np.uint64(0)) != 0)
                if not len(at):
                    continue
                if not len(run_at) or run_at[0] != 0:
                    run_at = np.append(0, run_at)
                sizes = np.diff(np.append(run_at, len(at)))
                at = at[np.repeat(_in_sketch(found.low[at[run_at]], bitmap, bits), sizes)]
                if not len(at):
                    continue
                doc = w.doc[at]
                used, local = np.unique(doc, return_inverse=True)
                held.append((found.low[at], local + base, at - w.first[doc],
                             grams(w.hash, window, _BASES[0])[at], grams(w.hash, window, _BASES[1])[at],
                             [keys[a + int(d)].as_py() for d in used]))
                base += len(used)
                n += len(at)
                if n >= FLUSH:
                    yield from settle(held, hot)
                    held, n, base = [], 0, 0
        if n:
            yield from settle(held, hot)
    return run


def _exact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by what they are dealt by; all rows of a value are grouped
    together, FLUSH windows or so at a time."""
    held: list[tuple] = []
    n, last = 0, None

    def settle() -> Iterator[pa.RecordBatch]:
        starts = [np.frombuffer(r[1], np.uint32) for r in held]
        h = np.concatenate([np.frombuffer(r[2], np.uint64).reshape(-1, 2) for r in held])
        owner = np.repeat(np.arange(len(held)), [len(s) for s in starts])
        start = np.concatenate(starts)
        repeated, _ = _repeats(h[:, 0].copy(), h[:, 1].copy())
        hit = np.flatnonzero(repeated | (start >= _FLAG))
        cut = np.flatnonzero(np.diff(owner[hit], prepend=-1))
        docs, out = [], []
        for a, b in zip(cut, np.append(cut[1:], len(hit))):
            docs.append(held[owner[hit[a]]][0])
            out.append((start[hit[a:b]] & ~_FLAG).tobytes())
        for a in range(0, len(docs), 8192):
            yield pa.RecordBatch.from_arrays([pa.array(docs[a:a + 8192], pa.binary()),
                                              pa.array(out[a:a + 8192], pa.binary())], ["doc", "starts"])

    for batch in batches:
        passed: list[tuple] = []
        for dealt, doc, starts, hashes in zip(*(batch.column(c).to_pylist() for c in ("dealt", "doc", "starts", "hashes"))):
            if hashes is None:
                passed.append((doc, starts))
                continue
            if dealt != last and n >= FLUSH:
                yield from settle()
                held, n = [], 0
            last = dealt
            held.append((doc, starts, hashes))
            n += len(starts) // 4
        if passed:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*passed)], ["doc", "starts"])
    if held:
        yield from settle()


def _remover(window: int, keep_text: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = batch.column("found").to_pylist()
            n_words, n_removed, kept_sha, kept_text = [], [], [], []
            for text, lists in zip(texts, found):
                parts = (text or b"").split()
                n = len(parts)
                if lists:
                    cover = np.zeros(n + 1, np.int32)
                    starts = np.unique(np.concatenate([np.frombuffer(x, np.uint32) for x in lists]))
                    cover[starts] += 1
                    cover[np.minimum(starts + window, n)] -= 1
                    parts = list(compress(parts, np.cumsum(cover)[:n] == 0))
                kept = b" ".join(parts)
                n_words.append(n)
                n_removed.append(n - len(parts))
                kept_sha.append(hashlib.sha256(kept).hexdigest())
                if keep_text:
                    kept_text.append(kept)
            columns = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                       pa.array(kept_sha, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if keep_text:
                columns.append(pa.array(kept_text, pa.binary()).cast(pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def remove_repeats(docs: DataFrame, spark: SparkSession, window: int = WINDOW,
                   keep_text: bool = False, max_sketch_bytes: int = MAX_SKETCH_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and ``kept_text`` on request)."""
    prepare(spark)
    rows = pick(docs, doc_id="bigint", text="string").withColumn("doc", row_key(F.col("doc_id"), F.col("text")))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # About one selected gram per 64 bytes; four cells for each, up to the bound.
    bits = min(max((size // 16).bit_length(), 13), (max_sketch_bytes * 8 // DEPTH).bit_length() - 1)
    sketch = spark.sparkContext.broadcast(build_sketch(rows, spark, window, bits))
    found = map_batches(rows.select("doc", "text"), _candidates(window, bits, sketch), _FOUND)
    exact = map_batches(found.repartition("dealt").sortWithinPartitions("dealt"), _exact, "doc binary, starts binary")
    marks = exact.groupBy("doc").agg(F.collect_list("starts").alias("found"))
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    return map_batches(rows.join(marks.hint("shuffle_hash"), "doc", "left").select("doc_id", "text", "found"),
                       _remover(window, keep_text), schema + ", kept_text string" * keep_text)
