"""Near-duplicate groups by DartMinHash signatures, banded joining and exact verification.

Signatures.  A text is a weighted set of word shingles (five words; a shorter text is one
shingle of all its words).  Each shingle owns an infinite strip of weight x rank plane; a
hash throws Poisson darts into it, in dyadic weight regions [0,1), [1,2), [2,4), ...  A
text keeps the darts whose weight coordinate lies below the shingle's weight and whose rank
is below ``phi ~ k (ln k + 2) / total weight``, so about ``k ln k`` darts in all however long
the text is.  Every dart is hashed to one of ``k`` coordinates; the earliest dart of a
coordinate is its signature entry.  Texts agree in a coordinate with probability equal to
their (weighted) Jaccard similarity; a coordinate left empty repeats the throw with a
doubled ``phi`` for that text.

Groups.  Texts with the same word sequence collapse to one node first.  Nodes that share a
band (``rows`` coordinates) are candidates:

* star round: each band bucket is compared with its pivot, the member that shares the most
  band collisions with others; links are verified on the complete shingle sets and linked
  nodes contracted to components;
* rest round: buckets that still hold several components compare the members of different
  components block by block (``BLOCK`` nodes a side, so no task holds a bucket) on their
  complete shingle sets; only the components that such a link touches are worked on again.

Inside a component no further pair can change the classes, so no link between classes is
lost, and a group of copies costs one row per member, not one per pair.  With 24 bands of 6
a pair at similarity 0.8 becomes a candidate with probability 0.9993.

Defined cases: NULL and empty texts, and texts without a word, are classes of their own
row; repeated rows and equal word sequences are one class; ``class_id`` is the smallest
``doc_id`` of the class (NULL only if all are NULL); an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.llm.common import keep_keys, map_batches, packed, pick, prepare, row_key, stored
from offerlake.llm.components import components, joined
from offerlake.llm.textnp import alnum_or_high, byte_values, grams, mix, sets_of, words

SHINGLE = 5
BANDS = 24
ROWS = 6
BLOCK = 1000
BLOCK_BYTES = 16 << 20
_NONE = np.uint64(0)


def shingles(w, rows: int, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row of a chunk, as (row, hash, multiplicity, offsets)."""
    g = mix(grams(w.hash, n), 5)
    ok = w.doc[:len(g)] == w.doc[n - 1:] if len(g) else np.zeros(0, bool)
    row, h = w.doc[:len(g)][ok], g[ok]
    count = np.diff(w.first)
    for r in np.flatnonzero((count > 0) & (count < n)):
        words_of = w.hash[w.first[r]:w.first[r + 1]]
        row = np.append(row, r)
        h = np.append(h, mix(grams(words_of, len(words_of)), 50 + len(words_of)))
    return sets_of(row, h, rows)


def dart_signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int, k: int,
                    seed: int = 0) -> np.ndarray:
    """Signatures (rows x k, uint64) of weighted sets; rows without elements stay zero."""
    out = np.zeros((rows, k), np.uint64)
    total = np.bincount(row, weights=weight, minlength=rows)
    phi = k * (np.log(k) + 2) / np.maximum(total, 1e-300)
    todo = total > 0
    while todo.any():
        use = todo[row]
        _throw(out, row[use], element[use], weight[use], phi, k, seed)
        todo &= (out == _NONE).any(axis=1)
        phi = np.where(todo, 2 * phi, phi)
        out[todo] = _NONE
    return out


def _throw(out: np.ndarray, row: np.ndarray, element: np.ndarray, weight: np.ndarray, phi: np.ndarray,
           k: int, seed: int) -> None:
    ranks, keys, darts = [], [], []
    top = int(np.ceil(np.log2(max(weight.max(), 1)))) if len(weight) else 0
    for region in range(top + 1):
        low, width = (0.0, 1.0) if region == 0 else (2.0 ** (region - 1), 2.0 ** (region - 1))
        at = np.flatnonzero(weight > low)
        strip = mix(element[at], seed * 64 + region + 1)
        rank, limit, throw = np.zeros(len(at)), phi[row[at]], 0
        while len(at):
            throw += 1
            dart = mix(strip, 1000 + throw)
            # Arrivals of a Poisson process of rate ``width`` along the rank axis.
            rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 1.0) / 2.0 ** 53) / width
            live = rank < limit
            at, strip, rank, limit, dart = at[live], strip[live], rank[live], limit[live], dart[live]
            where = low + width * (mix(dart, 7) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53
            hit = where < weight[at]
            d = mix(dart[hit], 9) | np.uint64(1)
            ranks.append(rank[hit])
            keys.append(row[at][hit] * k + (mix(d, 13) % np.uint64(k)).astype(np.int64))
            darts.append(d)
    rank, key, dart = (np.concatenate(x) for x in (ranks, keys, darts))
    last = np.argsort(-rank, kind="stable")  # the earliest dart is written last
    out.reshape(-1)[key[last]] = dart[last]


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band."""
    n = len(signature)
    folded = np.zeros((n, bands), np.uint64)
    parts = signature.reshape(n, bands, rows)
    for i in range(rows):
        folded = mix(folded * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i], 17)
    return mix(folded + np.arange(bands, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F), 19)


def _node(w, r: int) -> bytes | None:
    """Identity of a word sequence; None for a text without words."""
    h = w.hash[w.first[r]:w.first[r + 1]]
    return hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None


def _weights(count: np.ndarray, weighting: str) -> np.ndarray:
    return np.ones(len(count)) if weighting == "set" else count.astype(np.float64)


def _sign(bands: int, rows: int, weighting: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_word, values = alnum_or_high(), byte_values(True)
        seen: set[bytes] = set()
        for batch in batches:
            for a, b, w in words(batch.column("text"), is_word, values):
                nodes = [_node(w, r) for r in range(b - a)]
                # Later copies in this task need no signature of their own.
                new = np.zeros(b - a, bool)
                for i, node in enumerate(nodes):
                    if node is not None and node not in seen:
                        new[i] = True
                        if len(seen) < 1 << 20:
                            seen.add(node)
                row, h, count, _ = shingles(w, b - a)
                use = new[row]
                sig = dart_signatures(row[use], h[use], _weights(count[use], weighting), b - a, bands * rows)
                keys = band_keys(sig, bands, rows).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), batch.column("row").slice(a, b - a),
                     pa.array(nodes, pa.binary()),
                     pa.array([k.tolist() if n else None for k, n in zip(keys, new)], pa.list_(pa.int64()))],
                    ["doc_id", "row", "node", "bands"])
    return run


def _sets(wanted_by: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_word, values = alnum_or_high(), byte_values(True)
        for batch in batches:
            for a, b, w in words(batch.column("text"), is_word, values):
                _, h, count, at = shingles(w, b - a)
                both = h if wanted_by == "set" else None
                rows = []
                for r in range(b - a):
                    s = slice(at[r], at[r + 1])
                    rows.append((h[s] if both is not None else np.stack([h[s], count[s].astype(np.uint64)], 1)).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_node(w, r) for r in range(b - a)], pa.binary()), pa.array(rows, pa.binary())],
                    ["node", "elements"])
    return run


def similarity(x, y, weighting: str) -> float:
    """Exact (weighted) Jaccard similarity of two stored shingle sets (buffers)."""
    if weighting == "set":
        a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = np.concatenate([a, b])
        both.sort()
        shared = int((both[1:] == both[:-1]).sum())
        return shared / max(len(both) - shared, 1)
    a, b = np.frombuffer(x, np.uint64).reshape(-1, 2), np.frombuffer(y, np.uint64).reshape(-1, 2)
    _, i, j = np.intersect1d(a[:, 0], b[:, 0], assume_unique=True, return_indices=True)
    low = float(np.minimum(a[i, 1], b[j, 1]).sum())
    return low / max(float(a[:, 1].sum() + b[:, 1].sum()) - low, 1.0)


def _verify(threshold: float, weighting: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [similarity(x.as_buffer(), y.as_buffer(), weighting) >= threshold
                    for x, y in zip(batch.column("x"), batch.column("y"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _links(pairs: DataFrame, sets: DataFrame, threshold: float, weighting: str) -> DataFrame:
    """The pairs (a, b) whose stored sets reach the threshold."""
    x = sets.select(F.col("node").alias("a"), F.col("elements").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("elements").alias("y"))
    return map_batches(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y"),
                       _verify(threshold, weighting), "a binary, b binary")


class Merged:
    """Components already joined by a link of this task."""

    def __init__(self) -> None:
        self.up: dict[bytes, bytes] = {}

    def find(self, x: bytes) -> bytes:
        while (y := self.up.get(x, x)) != x:
            x = y
        return x

    def join(self, x: bytes, y: bytes) -> None:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


class Overlaps:
    """Index of the shingle sets of some nodes: exact similarity of a set to all of them."""

    def __init__(self, sets: list[bytes], weighting: str):
        self.weighting = weighting
        parts = [self.split(x) for x in sets]
        self.size = np.array([c.sum() for _, c in parts], np.float64)
        element = np.concatenate([e for e, _ in parts])
        order = np.argsort(element, kind="stable")
        self.element, self.count = element[order], np.concatenate([c for _, c in parts])[order]
        self.owner = np.repeat(np.arange(len(sets)), [len(e) for e, _ in parts])[order]

    def split(self, x: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Elements and their counts."""
        if self.weighting == "set":
            e = np.frombuffer(x, np.uint64)
            return e, np.ones(len(e), np.int64)
        pairs = np.frombuffer(x, np.uint64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1].astype(np.int64)

    def similarities(self, x: bytes) -> np.ndarray:
        e, c = self.split(x)
        first = np.searchsorted(self.element, e, "left")
        n = np.searchsorted(self.element, e, "right") - first
        at = np.repeat(first - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(int(n.sum()))
        low = np.bincount(self.owner[at], np.minimum(self.count[at], np.repeat(c, n)), len(self.size))
        return low / np.maximum(self.size + c.sum() - low, 1.0)


def _block_links(threshold: float, weighting: str):
    """Rows arrive sorted by block pair; emits verified links that join components."""
    def links(key: int, rows: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        left = [r for r in rows if r[1] in (0, 2)]
        right = [r for r in rows if r[1] in (1, 2)]
        if not left or not right:
            return
        bands = np.array([r[4] for r in right], np.int64)
        comps = np.array([r[3] for r in right], object)
        if len({r[3] for r in rows}) == 1:
            return
        overlaps = Overlaps([r[5] for r in right], weighting)
        merged = Merged()
        for _, side, node, comp, own_bands, elements in left:
            near = np.flatnonzero((overlaps.similarities(elements) >= threshold) & (comps != comp))
            # A pair that shares several buckets is looked at in the first of them only.
            shared = bands[near] == np.array(own_bands)
            near = near[bands[near, shared.argmax(axis=1)] == key]
            for i in near:
                other = right[i]
                if (side != 2 or node < other[2]) and merged.find(comp) != merged.find(other[3]):
                    merged.join(comp, other[3])
                    yield min(node, other[2]), max(node, other[2])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(key, rows):
            made = list(links(key, rows))
            return pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], pa.binary()) for i in (0, 1)], ["a", "b"])
        held, last = [], None
        names = ("key", "block", "side", "node", "comp", "bands", "elements")
        for batch in batches:
            for key, *row in zip(*(batch.column(c).to_pylist() for c in names)):
                if (key, row[0]) != last and held:
                    yield flush(last[0], held)
                    held = []
                last = (key, row[0])
                held.append(tuple(row))
        if held:
            yield flush(last[0], held)
    return run


def _rest_links(members: DataFrame, comps: DataFrame, nodes: DataFrame, sets: DataFrame, threshold: float,
                weighting: str) -> DataFrame:
    """Links between different components that share a bucket."""
    comp = F.coalesce("comp", "node").alias("comp")
    m = members.join(comps, "node", "left").select("key", "node", comp)
    # A bucket settled by its pivot: one component, or two members (just compared).
    several = m.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n")) \
        .where("lo <> hi AND n > 2").select("key")
    m = m.join(several, "key").join(nodes, "node").join(sets, "node")
    size = m.groupBy("key").agg(F.greatest(F.ceil(F.count("*") / F.lit(BLOCK)),
                                           F.ceil(F.sum(F.octet_length("elements")) / F.lit(BLOCK_BYTES)))
                                .cast("int").alias("blocks"))
    m = (m.join(size, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
         .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
         .withColumn("block", F.least("own", "other") * F.col("blocks") + F.greatest("own", "other"))
         .withColumn("side", F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)))
    return map_batches(m.select("key", "block", "side", "node", "comp", "bands", "elements")
                       .repartition("key", "block").sortWithinPartitions("key", "block"),
                       _block_links(threshold, weighting), "a binary, b binary")


def near_duplicates(docs: DataFrame, spark: SparkSession, threshold: float = 0.8, bands: int = BANDS,
                    rows: int = ROWS, weighting: str = "set") -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept, ``row`` (the identity of
    (doc_id, text)) and ``class_key`` (the same for all rows of a class).  ``weighting``: "set" weighs each distinct shingle 1 (Jaccard),
    "count" by its multiplicity (weighted Jaccard)."""
    prepare(spark)
    source = pick(docs, doc_id="bigint", text="string").withColumn("row", row_key(F.col("doc_id"), F.col("text")))
    signed = stored(map_batches(source, _sign(bands, rows, weighting),
                                "doc_id bigint, row binary, node binary, bands array<bigint>"),
                    spark, "signatures")
    nodes = stored(signed.where("bands IS NOT NULL").groupBy("node")
                   .agg(F.min("bands").alias("bands")), spark, "nodes")
    banded = nodes.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(banded.join(shared, "key"), spark, "members")
    degree = members.groupBy("node").agg(F.sum("n").alias("degree"))
    pivots = members.join(degree, "node").groupBy("key").agg(F.max(F.struct("degree", "node"))["node"].alias("a"))
    star = (members.join(pivots, "key").where("a <> node")
            .select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct())
    star = stored(star, spark, "pairs")
    # Only nodes that share a bucket need their complete sets: one row each.
    wanted = members.select("node").distinct()
    rep = stored(signed.where("bands IS NOT NULL").select("node", "row").join(wanted, "node")
                 .groupBy("node").agg(F.min("row").alias("row")).select("row"), spark, "representatives")
    sets = stored(map_batches(keep_keys(source, rep, "row").dropDuplicates(["row"]).select("text"), _sets(weighting),
                              "node binary, elements binary").dropDuplicates(["node"]), spark, "sets")
    links = stored(_links(star, sets, threshold, weighting), spark, "links")
    comps = components(links, spark)
    more = stored(_rest_links(members.select("key", "node"), comps, nodes, sets, threshold, weighting), spark, "links")
    if more.limit(1).count():
        comps = joined(comps, more, spark)
    by_node = (signed.where("node IS NOT NULL").groupBy("node")
               .agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
               .join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    classes = by_node.groupBy("comp").agg(F.min("low").alias("class_id"), F.sum("n").alias("class_size"))
    by_node = by_node.select("node", "comp").join(classes, "comp")
    return (signed.join(by_node, "node", "left")
            .select("doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("class_size", F.lit(1)).alias("class_size"),
                    (F.col("node").isNull() | F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"), "row",
                    F.coalesce("comp", "row").alias("class_key")))


def drop_near_duplicates(docs: DataFrame, spark: SparkSession, threshold: float = 0.8) -> DataFrame:
    """``docs`` with one row of each near-duplicate class, all columns unchanged."""
    found = near_duplicates(docs, spark, threshold).where("kept")
    # Rows without words are classes of their own; of rows that share id and class one stays.
    one = found.groupBy("class_key").agg(F.min("row").alias("row"))
    keep = stored(one.select("row").distinct(), spark, "kept")
    own = docs.select(packed(docs), row_key(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).alias("row"))
    return keep_keys(own, keep, "row").dropDuplicates(["row"]).select("own.*")
