"""Language identification by word-first backoff.

Training counts words (runs of letters, lower-cased) per language.  A known word scores each
language by its smoothed log frequency there.  An unseen word falls back to its character
n-grams, from five letters down to one: the longest order of which the model knows any
n-gram of the word decides, by the mean log frequency of the known ones.  A text's scores
are the sums over its words; the best language wins (ties: the first by name).

The model is fitted on a bounded sample (``max_rows`` rows in hash order, texts of at most
``max_text_bytes``) and holds at most ``MAX_WORDS`` words and ``MAX_GRAMS`` n-grams of each
order, so it may be broadcast; every whole text is scored once, without a shuffle.

Defined cases: NULL and empty texts and texts without a letter are ``und`` with score 0, as
is everything when nothing could be learnt (combining marks alone and unassigned code points
are no letters); NULL languages are not learnt from; very long texts are scored whole, and
those above ``max_text_bytes`` are not learnt from; repeated rows score alike; a tie of
languages goes to the first by name; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.llm.common import id_remainder, map_batches, pick, prepare
from offerlake.llm.textnp import _power, grams, mix

ORDERS = (5, 4, 3, 2, 1)
MAX_ROWS = 4000
MAX_TEXT_BYTES = 32 << 10
MAX_WORDS = 100_000
MAX_GRAMS = 50_000
CHUNK_CHARS = 1 << 19
SMOOTH = 0.5


@lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Code points that are letters, and those that belong to words: letters and the marks
    that combine with them.  Planes 4 and above hold neither."""
    letter = np.array([chr(c).isalpha() for c in range(0x40000)])
    mark = np.array([unicodedata.category(chr(c))[0] == "M" for c in range(0x20000)])
    return letter, letter | np.append(mark, np.zeros(0x20000, bool))


class Tokens:
    """Words of some texts: code points, word ranges and hashes, owning text."""

    def __init__(self, texts: list[str]):
        lowered = [t.lower() for t in texts]
        codes = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        begin = np.append(0, np.cumsum([len(t) + 1 for t in lowered]))
        letter, member = _letters()
        known = codes < len(letter)
        place = np.where(known, codes, 0)
        edge = np.diff((member[place] & known).astype(np.int8), prepend=0, append=0)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # Marks without any letter are no word.
        letters = np.append(0, np.cumsum(letter[place] & known))
        real = letters[self.end] > letters[self.start]
        self.start, self.end = self.start[real], self.end[real]
        self.text = np.searchsorted(begin, self.start, "right") - 1
        self.values = mix(codes.astype(np.uint64), 41)
        power, inverse = _power(len(codes) + 1)
        total = np.append(np.uint64(0), np.cumsum(self.values * power[:-1], dtype=np.uint64))
        self.hash = mix((total[self.end] - total[self.start]) * inverse[self.start])

    def grams(self, which: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``which``, hash) of every n-gram inside the given words."""
        count = np.maximum(self.end[which] - self.start[which] - n + 1, 0)
        owner = np.repeat(np.arange(len(which)), count)
        at = self.start[which][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        return owner, mix(grams(self.values, n), n)[at] if len(at) else np.zeros(0, np.uint64)


@dataclass
class Table:
    """Sorted keys with a row of log frequencies (one per language) each."""
    keys: np.ndarray
    logs: np.ndarray

    @staticmethod
    def of(keys: np.ndarray, language: np.ndarray, weight: np.ndarray, n: int, limit: int, least: int) -> Table:
        kinds, back = np.unique(keys, return_inverse=True)
        count = np.bincount(back * n + language, weight, minlength=len(kinds) * n).reshape(-1, n)
        total = count.sum(axis=0)
        # A language that hardly has n-grams of this order must not look uniform in them.
        total = np.where(total < 0.01 * total.mean(), total.mean(), total)
        keep = np.flatnonzero(count.sum(axis=1) >= least)
        keep = np.sort(keep[np.argsort(-count[keep].sum(axis=1), kind="stable")[:limit]])
        logs = np.log((count[keep] + SMOOTH) / (total + SMOOTH * len(kinds)))
        return Table(kinds[keep], logs.astype(np.float32))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 if unknown."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)


@dataclass
class Model:
    languages: list[str]
    words: Table
    orders: dict[int, Table]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        t = Tokens(texts)
        n = len(self.languages)
        total = np.zeros((len(texts), n))
        row = self.words.find(t.hash)
        known = np.flatnonzero(row >= 0)
        for k in range(n):
            total[:, k] += np.bincount(t.text[known], self.words.logs[row[known], k], minlength=len(texts))
        # Backoff once per distinct unseen word.
        unseen = np.flatnonzero(row < 0)
        _, at, back = np.unique(t.hash[unseen], return_index=True, return_inverse=True)
        which, score = unseen[at], np.zeros((len(at), n))
        open_ = np.arange(len(at))
        for order in ORDERS:
            if not len(open_):
                break
            owner, h = t.grams(which[open_], order)
            found = self.orders[order].find(h)
            owner, found = owner[found >= 0], found[found >= 0]
            count = np.bincount(owner, minlength=len(open_))
            for k in range(n):
                sums = np.bincount(owner, self.orders[order].logs[found, k], minlength=len(open_))
                score[open_, k] = sums / np.maximum(count, 1)
            open_ = open_[count == 0]
        for k in range(n):
            total[:, k] += np.bincount(t.text[unseen], score[back, k], minlength=len(texts))
        words = np.bincount(t.text, minlength=len(texts))
        best = total.argmax(axis=1)
        # Confidence from the mean score per word, as if of at most 20 words.
        scaled = total * (np.minimum(words, 20) / np.maximum(words, 1))[:, None]
        score = 1.0 / np.exp(scaled - scaled.max(axis=1, keepdims=True)).sum(axis=1)
        return ([self.languages[b] if w else "und" for b, w in zip(best, words)], np.where(words > 0, score, 0.0))


def train(texts: list[str], langs: list[str]) -> Model | None:
    languages = sorted(set(langs))
    if not languages:
        return None
    number = np.array([languages.index(x) for x in langs], np.int64)
    found: dict[int, list[tuple[np.ndarray, ...]]] = {size: [] for size in (0, *ORDERS)}  # 0: whole words
    start = 0
    while start < len(texts):
        stop, chars = start, 0
        while stop < len(texts) and (stop == start or chars + len(texts[stop]) <= CHUNK_CHARS):
            chars += len(texts[stop])
            stop += 1
        t = Tokens(texts[start:stop])
        language = number[start:stop][t.text]
        at, weight = _pairs(t.hash, language, np.ones(len(t.hash)))
        found[0].append((t.hash[at], language[at], weight))
        for size in ORDERS:
            owner, h = t.grams(at, size)
            lang = language[at][owner]
            first, sums = _pairs(h, lang, weight[owner])
            found[size].append((h[first], lang[first], sums))
        start = stop
    tables = {size: Table.of(*(np.concatenate([f[i] for f in found[size]]) for i in range(3)), len(languages),
                             MAX_GRAMS if size else MAX_WORDS, 3 if size else 2) for size in found}
    return Model(languages, tables.pop(0), tables)


def _pairs(keys: np.ndarray, language: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One index per distinct (key, language) and the summed weight of each."""
    order = np.lexsort((language, keys))
    k, x = keys[order], language[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (x[1:] != x[:-1])
    at = np.flatnonzero(new)
    return order[at], np.add.reduceat(weight[order], at) if len(at) else weight[:0]


def fit(docs: DataFrame, use: Column, max_rows: int = MAX_ROWS, max_text_bytes: int = MAX_TEXT_BYTES) -> Model | None:
    rows = pick(docs, doc_id="bigint", text="string", lang="string").where("text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.where(use).where(F.octet_length("text") <= max_text_bytes)
    ids = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    sample = rows.join(F.broadcast(ids), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text", "lang") \
        .limit(max_rows).collect()
    return train([r["text"] for r in sample], [r["lang"] for r in sample])


def _predictor(model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            langs, scores, start = [], [], 0
            while start < len(texts):
                stop, size = start, 0
                while stop < len(texts) and (stop == start or size + len(texts[stop]) <= CHUNK_CHARS):
                    size += len(texts[stop])
                    stop += 1
                if model.value is None:
                    got = (["und"] * (stop - start), np.zeros(stop - start))
                else:
                    got = model.value.predict(texts[start:stop])
                langs += got[0]
                scores.append(got[1])
                start = stop
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()),
                 pa.array(np.concatenate(scores) if scores else [], pa.float64())], ["doc_id", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, spark: SparkSession, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score; rows whose crc32(doc_id) mod 4 is 2 are held out
    of training."""
    prepare(spark)
    held = F.coalesce(id_remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = spark.sparkContext.broadcast(fit(docs, ~held & F.col("doc_id").isNotNull(), max_rows))
    out = map_batches(pick(docs, doc_id="bigint", text="string"), _predictor(model),
                      "doc_id bigint, lang_pred string, score double")
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
