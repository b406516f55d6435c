"""Ranked lexical search by NRA (no random access).

Score of a document for an item: the sum, over the item's terms with repeats, of the
document's impact for that term, ``w * ((10^9 tf) div (1000 tf + 8 m))`` with a term weight
``w`` falling with the document frequency and a length measure ``m``.

Method.  One map over the documents counts every document's words and keeps the
occurrences of terms that some item of the block uses (a block of items has at most
``MAX_TERMS`` terms, or is one item).  These rows are written to the shared folder; Spark
adds up documents, words and document frequencies over all of them.

A second map searches.  Each task takes the counted documents in parts of at most
``PART_POSTINGS`` postings (or one document), and turns a part into one impact-sorted list
per term.  For each item the lists are read sequentially, greatest impacts first, down to a
level that falls by ``STEP`` from round to round, and no posting is read out of its turn.
A document met has a lower bound, the sum of the impacts read, and an upper bound, which
adds for each of the item's lists in which it was not met the greatest impact the list
still holds (0 once it ends); a document not met yet has the sum of all those.  The
threshold is the k-th greatest of the lower bounds and of the scores of the task's parts
before.  Once no new document can reach it, documents whose upper bound is below it go, and
the rest of the lists is read for those that stay, until both bounds meet: membership, ties
and scores are then final.  Documents that equal the threshold stay, so ties are complete.

A task returns the k best of each item, and a window with a partial top-k per task (Spark's
window group limit) ranks those.  Documents never leave their task, so a term or an item
that matches everything is read where its documents are; there is no list, item or
threshold that all rows of the corpus go through.  Tasks get the terms, weights and items
of the block with their code: bounded by ``MAX_TERMS`` (12 bytes each) or one item.

Defined cases: NULL texts have no term; documents and items without a term are in no result
(documents without one do not count for ``N``); very long texts are read whole; every row
is a document or an item of its own, also if ids repeat; equal scores rank by ascending
``doc_id``, NULL ids last; impacts of 0 give no score, and only scores above 0 are returned;
empty tables give an empty result; extra columns are ignored, whatever their names.  Words
are told apart by 64-bit hashes (a foreign word equals one of V terms with a chance of
V / 2^64).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlake.llm import textnp
from offerlake.llm.common import map_batches, pick, prepare, stored

K = 10
MAX_TERMS = 200_000
PART_POSTINGS = 1_500_000
#: Ratio of the impact levels of two rounds.
STEP = 0.6
#: Impacts before the weight are below 2^20 (10^9 tf / 1000 tf is 10^6).
IMPACT_BITS = 20
NO_ID = np.iinfo(np.int64).max


# --- words -----------------------------------------------------------------------------------

def _words(column: pa.Array) -> Iterator[tuple[int, int, textnp.Words]]:
    """Words of the class [0-9A-Za-z and everything beyond ASCII], A-Z lower-cased."""
    return textnp.words(column, textnp.alnum_or_high(), textnp.byte_values(fold_ascii=True))


def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        uid, ids = batch.column("item"), batch.column("item_id")
        for a, b, w in _words(batch.column("text")):
            row, h, count, _ = textnp.sets_of(w.doc, w.hash, b - a)
            at = pa.array(row + a)
            yield pa.RecordBatch.from_arrays([uid.take(at), ids.take(at), pa.array(h.view(np.int64)), pa.array(count)],
                                             ["item", "item_id", "term", "repeats"])


def item_terms(items: DataFrame) -> DataFrame:
    """item (row), item_id, term, repeats; one row per distinct term of an item."""
    rows = pick(items, item_id="bigint", text="string").where(F.col("text").isNotNull())
    return map_batches(rows.withColumn("item", F.monotonically_increasing_id()), _item_terms,
                       "item bigint, item_id bigint, term bigint, repeats bigint")


def _blocks(items: DataFrame, max_terms: int) -> list[tuple[int, int]]:
    """Ranges of item rows whose terms number at most ``max_terms`` (or one item)."""
    sizes = items.groupBy("item").agg(F.count("*").alias("n")).orderBy("item")
    blocks: list[list[int]] = []
    total = 0
    for r in sizes.toLocalIterator():
        if not blocks or total + r["n"] > max_terms:
            blocks.append([r["item"], r["item"]])
            total = 0
        blocks[-1][1] = r["item"]
        total += r["n"]
    return [(a, b) for a, b in blocks]


def _counted(terms: np.ndarray):
    """Per document its word count and its occurrences of ``terms`` (ascending), by index."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, w in _words(batch.column("text")):
                at = np.minimum(np.searchsorted(terms, w.hash), len(terms) - 1)
                hit = terms[at] == w.hash
                row, term, count, offs = textnp.sets_of(w.doc[hit], at[hit], b - a)
                lists = pa.array(offs.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(np.diff(w.first).astype(np.int64)),
                     pa.ListArray.from_arrays(lists, pa.array(term.astype(np.int32))),
                     pa.ListArray.from_arrays(lists, pa.array(count.astype(np.int32)))], ["doc_id", "n", "terms", "tfs"])
    return run


# --- NRA ----------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Queries:
    """Items of a block: ``item`` numbers, and per item the indices of its terms and the
    factors (weight times repeats) of their impacts; ``weight`` of 0 has no factor."""
    item: list[int]
    terms: list[np.ndarray]
    factors: list[np.ndarray]
    n_terms: int


class Lists:
    """Impact-sorted list per term of one part of the documents."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_terms: int, ids: np.ndarray):
        order = np.argsort((term.astype(np.int64) << IMPACT_BITS) - impact)
        self.doc, self.impact, self.ids = doc[order], impact[order], ids
        self.first = np.searchsorted(term[order], np.arange(n_terms + 1))


def nra(lists: Lists, terms: np.ndarray, factors: np.ndarray, before: np.ndarray, k: int,
        step: float = STEP) -> tuple[np.ndarray, np.ndarray]:
    """(documents, exact scores) of all documents of the part that may be among the k best
    together with the scores ``before``."""
    used = lists.first[terms + 1] > lists.first[terms]
    docs = [lists.doc[lists.first[t]:lists.first[t + 1]] for t in terms[used]]
    falls = [-lists.impact[lists.first[t]:lists.first[t + 1]] for t in terms[used]]
    factor = factors[used].tolist()
    lower = np.zeros(len(lists.ids), np.int64)
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = [0] * len(docs)
    ahead = [-f * int(fall[0]) for f, fall in zip(factor, falls)]
    level, threshold = max(ahead), 0
    while True:
        for j, fall in enumerate(falls):
            if ahead[j] < level or not ahead[j]:
                continue
            # Down to the first posting below the level.
            end = int(np.searchsorted(fall, -level // factor[j], "right"))
            lower[docs[j][at[j]:end]] -= factor[j] * fall[at[j]:end]
            at[j] = end
            ahead[j] = -factor[j] * int(fall[end]) if end < len(fall) else 0
        met = np.flatnonzero(lower)
        known = np.concatenate([lower[met], before])
        if len(known) >= k:
            threshold = int(np.partition(known, len(known) - k)[len(known) - k])
        unseen = sum(ahead)
        if not unseen or unseen < threshold:
            break
        level = min(int(level * step), max(ahead))
    # No new document comes in: upper bounds of those met.
    upper = lower + unseen
    for j, a in enumerate(ahead):
        if a:
            upper[docs[j][:at[j]]] -= a
    stays = (lower > 0) & (upper >= threshold)
    # The rest of the lists, read for the documents that stay until their bounds meet.
    for j, fall in enumerate(falls):
        if ahead[j]:
            rest = docs[j][at[j]:]
            mine = stays[rest]
            lower[rest[mine]] -= factor[j] * fall[at[j]:][mine]
    found = np.flatnonzero(stays)
    return found, lower[found]


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -score))[:k]
    return score[order], ids[order]


def _parts(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """The rows again, in runs of at most ``limit`` postings (or one row)."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        size = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False))
        a = 0
        while a < len(size):
            done = int(size[a - 1]) if a else 0
            b = int(np.searchsorted(size, done + limit - total, "right"))
            if b == a and held:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, total = [], 0
                continue
            b = max(b, a + 1)
            held.append(batch.slice(a, b - a))
            total += int(size[b - 1]) - done
            a = b
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _searched(queries: Queries, n_docs: int, n_terms: int, k: int, limit: int, step: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        best = [(none, none)] * len(queries.item)
        for part in _parts(batches, limit):
            ids = pc.fill_null(part.column("doc_id"), int(NO_ID)).to_numpy(zero_copy_only=False)
            n = part.column("n").to_numpy(zero_copy_only=False)
            measure = 100 - 75 + (75 * n * n_docs) // n_terms
            doc = np.repeat(np.arange(len(n)), pc.list_value_length(part.column("terms")).to_numpy(zero_copy_only=False))
            term = part.column("terms").flatten().to_numpy(zero_copy_only=False)
            tf = part.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            impact = (1_000_000_000 * tf) // (1000 * tf + 8 * measure[doc])
            some = impact > 0
            lists = Lists(term[some], doc[some], impact[some], queries.n_terms, ids)
            for i in range(len(best)):
                found, score = nra(lists, queries.terms[i], queries.factors[i], best[i][0], k, step)
                best[i] = _best(np.concatenate([best[i][0], score]), np.concatenate([best[i][1], ids[found]]), k)
        item = np.repeat(np.array(queries.item, np.int64), [len(s) for s, _ in best])
        score = np.concatenate([s for s, _ in best])
        ids = np.concatenate([i for _, i in best])
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=ids == NO_ID), pa.array(score)],
                                         ["item", "doc_id", "score"])
    return run


def _queries(items: DataFrame, terms: np.ndarray, weight: np.ndarray) -> Queries:
    """The block's items on the driver: at most MAX_TERMS rows, or one item."""
    rows: dict[int, list[tuple[int, int]]] = {}
    for r in items.toLocalIterator():
        rows.setdefault(r["item"], []).append((r["term"], r["repeats"]))
    out = Queries([], [], [], len(terms))
    for item, pairs in rows.items():
        at = np.searchsorted(terms, np.array([t for t, _ in pairs], np.int64).view(np.uint64))
        factor = weight[at] * np.array([q for _, q in pairs], np.int64)
        out.item.append(item)
        out.terms.append(at[factor > 0])
        out.factors.append(factor[factor > 0])
    return out


def _search_block(docs: DataFrame, items: DataFrame, spark: SparkSession, k: int, limit: int, step: float) -> DataFrame | None:
    """item, doc_id, score: the k best of each task."""
    # At most MAX_TERMS hashes, or the terms of one item.
    terms = np.sort(np.array([r["term"] for r in items.select("term").distinct().toLocalIterator()], np.int64).view(np.uint64))
    rows = pick(docs, doc_id="bigint", text="string")
    counted = stored(map_batches(rows, _counted(terms), "doc_id bigint, n bigint, terms array<int>, tfs array<int>"),
                     spark, "search-counts")
    total = counted.agg(F.count_if(F.col("n") > 0).alias("n_docs"), F.sum("n").alias("n_terms")).first()
    if not total["n_docs"]:
        return None
    df = np.zeros(len(terms), np.int64)
    holders = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    for r in holders.toLocalIterator():  # one row a term
        df[r["term"]] = r["df"]
    n_docs = total["n_docs"]
    weight = np.floor(1000.0 * np.log((2.0 * n_docs + 2.0) / (2.0 * df + 1.0))).astype(np.int64)
    queries = _queries(items, terms, weight)
    return map_batches(counted, _searched(queries, n_docs, total["n_terms"], k, limit, step),
                       "item bigint, doc_id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, spark: SparkSession, k: int = K, max_terms: int = MAX_TERMS,
           part_postings: int = PART_POSTINGS, step: float = STEP) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score."""
    prepare(spark)
    terms = stored(item_terms(items), spark, "search-item-terms")
    found = []
    for a, b in _blocks(terms, max_terms):
        block = terms.where(F.col("item").between(a, b))
        best = _search_block(docs, block, spark, k, part_postings, step)
        if best is not None:
            found.append(best)
    if not found:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = terms.select("item", "item_id").distinct()
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
