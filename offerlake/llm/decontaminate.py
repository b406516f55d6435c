"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are lower-cased and their whitespace runs become one space.  An
item is searched as windows of at most ``WINDOW`` characters (half overlapping; a shorter
item is one window), each with an edit budget ``k = floor(budget * length)``.

Filter.  A region within ``k`` edits of a window of ``m`` characters shares at least
``m + 1 - q - k q`` of its q-grams, on diagonals (text position - window position) that
differ by at most ``k``.  Shared q-grams are counted in diagonal bands of width ``2 (K + 1)``
that overlap by half (``K``: the largest budget), so each such region lies in one band
entirely.  Bands below the bound are dropped; counts only overestimate, so no region within
the budget is lost.  ``q`` shrinks for windows so short that the bound would not be
positive, down to exact search.

Verification.  The band's text region is aligned to the window with free ends on the text
side, in a band of diagonals, and accepted if some alignment stays within ``k`` edits.

The benchmark is the small side of a search: it is read in blocks of ``BLOCK_CHARS``
characters and each block is broadcast, whatever the number of blocks; every document is
scanned whole against every block, one task's batch at a time, without a shuffle of texts.

Defined cases: NULL and empty texts or items match nothing (an item of whitespace only is
empty); equal items are searched once and all their ids are reported; repeated documents
are judged alike; an empty benchmark leaves every document clean; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.llm.common import map_batches, pick, prepare, row_key, stored
from offerlake.llm.textnp import grams, mix

Q = 9
WINDOW = 128
BUDGET = 0.08
BLOCK_CHARS = 4 << 20
CHUNK_CHARS = 1 << 18
#: Index entries expanded at once (about 100 bytes each).
SLICE_ENTRIES = 1 << 20
_TABLE_BITS = 22


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def qgrams(codes: np.ndarray, q: int) -> np.ndarray:
    return mix(grams(codes.astype(np.uint64) + np.uint64(0x51ED27), q), q)


class Patterns:
    """The windows of a benchmark block and their q-gram index."""

    def __init__(self, items: list[tuple[int, str]], window: int, budget: float, q: int):
        by_text: dict[str, list[int]] = {}
        for item_id, text in items:
            if text := normalise(text):
                by_text.setdefault(text, []).append(item_id)
        self.ids, self.codes, self.edits, self.bound, self.q = [], [], [], [], []
        for text, ids in by_text.items():
            codes = code_points(text)
            last = max(len(codes) - window, 0)
            for a in sorted({*range(0, last + 1, max(window // 2, 1)), last}):
                part = codes[a:a + window]
                self.ids.append(ids)
                self.codes.append(part)
                k, size = int(budget * len(part)), min(q, len(part))
                while size > 1 and len(part) + 1 - size - k * size < 1:
                    size -= 1
                if len(part) + 1 - size - k * size < 1:
                    k = 0
                self.edits.append(k)
                self.q.append(size)
                self.bound.append(len(part) + 1 - size - k * size)
        self.edits, self.bound = np.array(self.edits, np.int64), np.array(self.bound, np.int64)
        self.reach = int(self.edits.max(initial=0)) + 1
        self.offset = max(map(len, self.codes), default=0) + self.reach  # keeps diagonals positive
        self.index = {}
        for size in sorted(set(self.q)):
            made = [(qgrams(c, size), i) for i, c in enumerate(self.codes) if self.q[i] == size]
            h = np.concatenate([m[0] for m in made])
            owner = np.repeat([m[1] for m in made], [len(m[0]) for m in made])
            at = np.concatenate([np.arange(len(m[0])) for m in made])
            order = np.argsort(h, kind="stable")
            h, owner, at = h[order], owner[order], at[order]
            keys, first = np.unique(h, return_index=True)
            maybe = np.zeros(1 << _TABLE_BITS, bool)
            maybe[(keys >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
            self.index[size] = (maybe, keys, np.append(first, len(h)), owner, at)

    def candidates(self, codes: np.ndarray, begin: np.ndarray) -> Iterator[np.ndarray]:
        """(window, text, band) triples whose shared q-grams reach the bound, slice by slice.
        ``begin``: offsets of the texts in ``codes``.

        A slice takes as many matching positions as have ``SLICE_ENTRIES`` index entries (a
        periodic text may match every entry at every position).  The positions that share a
        band with one window lie within ``span``; slices are at least two spans long and
        overlap by one, so every band is whole in some slice."""
        span = self.offset + 2 * self.reach
        for size, (maybe, keys, first, owner, at) in self.index.items():
            h = qgrams(codes, size)
            pos = np.flatnonzero(maybe[(h >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
            found = np.minimum(np.searchsorted(keys, h[pos]), len(keys) - 1)
            ok = keys[found] == h[pos]
            del h
            pos, found = pos[ok], found[ok]
            text = np.searchsorted(begin, pos, "right") - 1
            ok = pos + size <= begin[text + 1]
            pos, found, text = pos[ok], found[ok], text[ok]
            n = first[found + 1] - first[found]
            entries = np.append(0, np.cumsum(n))
            a = 0
            while a < len(pos):
                b = max(int(np.searchsorted(entries, entries[a] + SLICE_ENTRIES, "right")) - 1,
                        int(np.searchsorted(pos, pos[a] + 2 * span, "right")))
                b = min(b, len(pos))
                yield self._bands(pos[a:b], first[found[a:b]], n[a:b], text[a:b], begin, owner, at)
                a = b if b == len(pos) else int(np.searchsorted(pos, pos[b] - span))

    def _bands(self, pos, first, n, text, begin, owner, at) -> np.ndarray:
        entry = np.repeat(first - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(int(n.sum()))
        window = owner[entry]
        diagonal = np.repeat(pos - begin[text], n) - at[entry] + self.offset
        band = diagonal // self.reach
        keys_of = (window * len(begin) + np.repeat(text, n)) << 34
        # Band b holds the diagonals of half-bands b and b + 1.
        seen, count = np.unique(np.concatenate([keys_of + band, keys_of + band - 1]), return_counts=True)
        who = (seen >> 34) // len(begin)
        hit = count >= self.bound[who]
        return np.stack([who[hit], (seen[hit] >> 34) % len(begin), seen[hit] & ((1 << 34) - 1)], 1)

    def verify(self, window: int, text: np.ndarray, band: int) -> bool:
        k, pattern = int(self.edits[window]), self.codes[window]
        return within(pattern, text, band * self.reach - self.offset - k, 2 * self.reach + 2 * k, k)


def within(pattern: np.ndarray, text: np.ndarray, low: int, width: int, k: int) -> bool:
    """Does a substring of ``text`` align to ``pattern`` within ``k`` edits on the diagonals
    ``low <= text position - pattern position < low + width``?  Ends are free on the text
    side; positions outside the text match nothing."""
    a, b = low, low + len(pattern) + width
    region = np.full(b - a, 0xFFFFFFFF, np.uint32)
    inner = text[max(a, 0):max(b, 0)]
    region[max(-a, 0):max(-a, 0) + len(inner)] = inner
    cost, step = np.zeros(width, np.int32), np.arange(width, dtype=np.int32)
    for i, code in enumerate(pattern):
        new = cost + (region[i:i + width] != code)
        new[:-1] = np.minimum(new[:-1], cost[1:] + 1)
        cost = np.minimum.accumulate(new - step) + step  # extra text characters
        if i % 16 == 15 and cost.min() > k:
            return False
    return bool(cost.min() <= k)


def find_items(patterns: Patterns, texts: list[str | None]) -> list[list[int]]:
    """The ids of the benchmark items found in each text."""
    texts = [normalise(t) for t in texts]
    hits: list[list[int]] = [[] for _ in texts]
    start, most = 0, (1 << 29) // max(len(patterns.codes), 1) - 1  # (window, text, band) keys fit 63 bits
    while start < len(texts) and len(patterns.codes):
        stop, size = start, 0
        while stop < len(texts) and (stop == start or stop - start < most and size + len(texts[stop]) <= CHUNK_CHARS):
            size += len(texts[stop])
            stop += 1
        codes = code_points("".join(texts[start:stop]))
        begin = np.append(0, np.cumsum([len(t) for t in texts[start:stop]]))
        found: dict[int, set] = {}
        for triples in patterns.candidates(codes, begin):
            for window, text, band in triples.tolist():
                ids, done = patterns.ids[window], found.setdefault(text, set())
                if ids[0] not in done and patterns.verify(window, codes[begin[text]:begin[text + 1]], band):
                    done.update(ids)
        for text, ids in found.items():
            hits[start + text] = sorted(ids, key=lambda i: (i is None, i))
        start = stop
    return hits


def _scan(block):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = Patterns(*block.value)
        for batch in batches:
            hits = find_items(patterns, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(hits, pa.list_(pa.int64()))],
                ["doc_id", "row", "item_ids"])
    return run


def _clean(block, at: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = Patterns(*block.value)
        for batch in batches:
            hits = find_items(patterns, batch.column(at).cast(pa.string()).to_pylist())
            yield batch.filter(pa.array([not h for h in hits], pa.bool_()))
    return run


def _blocks(bench: DataFrame) -> Iterator[list[tuple[int, str]]]:
    held, size = [], 0
    for r in pick(bench, item_id="bigint", text="string").toLocalIterator():
        held.append((r["item_id"], r["text"]))
        size += len(r["text"] or "")
        if size >= BLOCK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def contaminated(docs: DataFrame, bench: DataFrame, spark: SparkSession, budget: float = BUDGET,
                 window: int = WINDOW, q: int = Q) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, item_ids, and ``row`` (the
    identity of doc_id and text)."""
    prepare(spark)
    rows = pick(docs, doc_id="bigint", text="string").withColumn("row", row_key(F.col("doc_id"), F.col("text")))
    schema = "doc_id bigint, row binary, item_ids array<bigint>"
    parts = [map_batches(rows, _scan(spark.sparkContext.broadcast((b, window, budget, q))), schema)
             for b in _blocks(bench)]
    if not parts:
        found = rows.select("doc_id", "row", F.array().cast("array<bigint>").alias("item_ids"))
    elif len(parts) == 1:
        found = parts[0]
    else:
        hits = parts[0]
        for p in parts[1:]:
            hits = hits.union(p)
        hits = stored(hits.where(F.size("item_ids") > 0), spark, "leaks").groupBy("row").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
        found = rows.select("doc_id", "row").join(hits, "row", "left").withColumn(
            "item_ids", F.coalesce("item_ids", F.array().cast("array<bigint>")))
    return found.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"),
                        F.size("item_ids").alias("n_items"), "item_ids", "row")


def drop_contaminated(docs: DataFrame, bench: DataFrame, spark: SparkSession, budget: float = BUDGET,
                      window: int = WINDOW, q: int = Q) -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage; one pass per block,
    no shuffle."""
    prepare(spark)
    schema, at = docs.schema, docs.columns.index("text")
    for b in _blocks(bench):
        docs = map_batches(docs, _clean(spark.sparkContext.broadcast((b, window, budget, q)), at), schema)
    return docs
