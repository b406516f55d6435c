"""Exact deduplication by Grace hashing.

Method.  Texts are equal when identical (NULL counts as empty).  Every scan task first
collapses its own copies in an open-addressing table that compares complete content, so a
group holding a third of all rows sends one row per task, not one per copy.  Spark's
shuffle on the content hash is the first partitioning pass; each receiving task fills an
open-addressing table and, when the distinct texts outgrow ``memory_bytes``, writes them
and the rest of its input to ``FANOUT`` spill files by further hash bits, then treats each
file the same way with fresh bits until a bucket fits.  Spill files belong to the task (as
Spark's own spills do): they are removed when it ends, and a lost executor's task simply
runs again from the shuffle.

The group table (one row per distinct text) is joined back to the rows by SHA-256 only;
that join's large side may be skewed on one text and is left to AQE's skew handling.

Defined cases: NULL and empty texts are one group; repeated rows (same id and text) are
members like any other, and the row with the largest ``doc_id`` is the one kept -- if
several rows share that id, ``kept`` is true for each of them (:func:`drop_duplicates`
keeps one); NULL ids never win over a real id; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.llm.common import map_batches, packed, pick, prepare

MEMORY_BYTES = 64 << 20
FANOUT_BITS = 4
FANOUT = 1 << FANOUT_BITS
_HEADER = struct.Struct("<qqqI")
NO_ID = -(1 << 63)


class ContentTable:
    """Open addressing with linear probing; a slot matches only if the complete text does."""

    def __init__(self) -> None:
        self.slots = np.full(1024, -1, np.int64)
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.best: list[int] = []
        self.counts: list[int] = []
        self.bytes = 0

    def _place(self, h: int) -> int:
        mask = len(self.slots) - 1
        at = (h ^ (h >> 32)) & mask
        while self.slots[at] >= 0:
            at = (at + 1) & mask
        return at

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        for i, h in enumerate(self.hashes):
            self.slots[self._place(h)] = i

    def find(self, h: int, text: bytes) -> int:
        mask = len(self.slots) - 1
        at = (h ^ (h >> 32)) & mask
        while (i := self.slots[at]) >= 0:
            if self.hashes[i] == h and self.texts[i] == text:
                return int(i)
            at = (at + 1) & mask
        return -1

    def add(self, h: int, text: bytes, best: int, count: int) -> None:
        i = self.find(h, text)
        if i >= 0:
            self.best[i] = max(self.best[i], best)
            self.counts[i] += count
            return
        if 2 * len(self.hashes) >= len(self.slots):
            self._grow()
        self.slots[self._place(h)] = len(self.hashes)
        self.hashes.append(h)
        self.texts.append(text)
        self.best.append(best)
        self.counts.append(count)
        self.bytes += len(text) + 64

    def rows(self) -> Iterator[tuple[int, bytes, int, int]]:
        return zip(self.hashes, self.texts, self.best, self.counts)


def _read(path: str) -> Iterator[tuple[int, bytes, int, int]]:
    with open(path, "rb") as f:
        while head := f.read(_HEADER.size):
            h, best, count, n = _HEADER.unpack(head)
            yield h, f.read(n), best, count


def grace(rows: Iterable[tuple[int, bytes, int, int]], memory_bytes: int, folder: str,
          shift: int = 0) -> Iterator[ContentTable]:
    """Tables that together hold each distinct text of ``rows`` once.  ``shift`` is the
    number of hash bits the recursion has used; past the last bit (texts whose 64-bit
    hashes agree) one table takes the rest."""
    table, files, paths = ContentTable(), None, []
    try:
        for h, text, best, count in rows:
            if files is None:
                table.add(h, text, best, count)
                if table.bytes <= memory_bytes or shift >= 64:
                    continue
                paths = [os.path.join(folder, f"{shift}-{os.urandom(6).hex()}") for _ in range(FANOUT)]
                files = [open(p, "wb") for p in paths]
                spill, table = table.rows(), ContentTable()
            else:
                spill = ((h, text, best, count),)
            for g, t, b, c in spill:
                out = files[(g >> shift) & (FANOUT - 1)]
                out.write(_HEADER.pack(g, b, c, len(t)))
                out.write(t)
    finally:
        for f in files or ():
            f.close()
    if files is None:
        if table.hashes:
            yield table
        return
    for p in paths:
        yield from grace(_read(p), memory_bytes, folder, shift + FANOUT_BITS)
        os.remove(p)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes, int, int]]:
    ids = batch.column("best").to_pylist()
    counts = batch.column("n").to_pylist()
    texts = batch.column("text").cast(pa.binary())
    for i, h in enumerate(batch.column("h").to_pylist()):
        yield h, texts[i].as_py(), ids[i], counts[i]


def _partials(tables: Iterable[ContentTable]) -> Iterator[pa.RecordBatch]:
    for t in tables:
        for a in range(0, len(t.texts), 2048):
            b = a + 2048
            yield pa.RecordBatch.from_arrays(
                [pa.array(t.hashes[a:b], pa.int64()), pa.array(t.texts[a:b], pa.binary()).cast(pa.string()),
                 pa.array(t.best[a:b], pa.int64()), pa.array(t.counts[a:b], pa.int64())],
                ["h", "text", "best", "n"])


def _collapse(memory_bytes: int):
    """Map side: flush the table whenever it is full; what it emits is merged later."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable()
        for batch in batches:
            for h, text, best, count in _rows(batch):
                table.add(h, text, best, count)
                if table.bytes > memory_bytes:
                    yield from _partials([table])
                    table = ContentTable()
        yield from _partials([table])
    return run


def _merge(memory_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        with tempfile.TemporaryDirectory(prefix="grace-") as folder:
            rows = (r for batch in batches for r in _rows(batch))
            for t in grace(rows, memory_bytes, folder):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hashlib.sha256(x).digest() for x in t.texts], pa.binary()),
                     pa.array(t.best, pa.int64()), pa.array(t.counts, pa.int64())], ["sha", "keep_id", "group_size"])
    return run


def groups(docs: DataFrame, memory_bytes: int = MEMORY_BYTES) -> DataFrame:
    """One row per distinct text: ``sha`` (32 bytes), ``keep_id``, ``group_size``."""
    rows = pick(docs, doc_id="bigint", text="string").select(
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(NO_ID)).alias("best"))
    rows = rows.select(F.xxhash64("text").alias("h"), "text", "best", F.lit(1).cast("bigint").alias("n"))
    partial = map_batches(rows, _collapse(memory_bytes // 2), "h bigint, text string, best bigint, n bigint")
    merged = map_batches(partial.repartition("h"), _merge(memory_bytes),
                         "sha binary, keep_id bigint, group_size bigint")
    return merged.withColumn("keep_id", F.nullif("keep_id", F.lit(NO_ID)))


def exact_groups(docs: DataFrame, spark: SparkSession, memory_bytes: int = MEMORY_BYTES) -> DataFrame:
    """Every row with its group: doc_id, keep_id, group_size, kept, text_sha256."""
    prepare(spark)
    rows = pick(docs, doc_id="bigint", text="string").select(
        "doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("sha"))
    return rows.join(groups(docs, memory_bytes), "sha").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_duplicates(docs: DataFrame, spark: SparkSession, memory_bytes: int = MEMORY_BYTES) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns unchanged."""
    prepare(spark)
    keep = groups(docs, memory_bytes).select("sha", "keep_id")
    sha = F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256))
    own = docs.select(packed(docs), F.col("doc_id").cast("bigint").alias("id"), sha.alias("sha"))
    on = (own["sha"] == keep["sha"]) & own["id"].eqNullSafe(keep["keep_id"])
    return own.join(keep, on, "left_semi").dropDuplicates(["sha"]).select("own.*")
