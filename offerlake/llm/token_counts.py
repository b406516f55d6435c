"""Token counts by rank-synchronous array merging.

Method.  A byte-fallback BPE model of the sentencepiece library is turned into arrays: a
symbol per character, a sorted table of the symbol pairs that merge, each with the rank of
its score.  A batch of texts becomes one array of symbols, cut into pre-tokens wherever no
piece of the vocabulary holds the two neighbouring characters side by side (no merge can
ever cross such a place, so the cuts change nothing).  Equal pre-tokens of a batch are
merged once.  All pre-tokens are then held as one ragged array and merged in rounds: every
round applies each sequence's lowest-rank pair, left to right and without overlaps, in all
sequences at once; a sequence without a pair leaves, and its surviving symbols are counted.

The library applies one pair at a time (best score, then leftmost).  Applying all places of
a rank at once gives the same unless the merged piece begins or ends another piece of the
same or a better rank; for those ranks (found once from the vocabulary) a round applies the
leftmost place of a sequence only.  A pre-token of more than ``LONG`` symbols would need
many rounds over all its symbols; its places are held by rank instead, and a round touches
only those of the rank it applies.  Results do not depend on ``LONG``.

The normaliser is the model's own.  Whole texts are counted; the work is a map over the
rows, without a shuffle.

Defined cases: NULL and empty texts have no token and no byte; very long texts are counted
in slices cut between pre-tokens; characters outside the vocabulary count one token a byte;
special strings (``<s>``) inside a text are plain text, as in the library; ties of rank go
left to right; repeated rows and NULL ids are rows like any other; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.llm.common import map_batches, pick, prepare
from offerlake.llm.textnp import mix

LIMIT = 4096
LONG = 2048
SLICE = 1 << 20
GROUP_CHARS = 1 << 20
NO_RANK = np.int32(2 ** 31 - 1)
_ROLL = np.uint64(0x9E3779B97F4A7C15)
#: Texts on which a model must agree with the library before it is used.
PROBES = ("", " ", "a", "Hello  world\n\tx", "<s> </s> <unk> <0x41>", "é中\U0001F600 ▁▁x", "aaaaaaa      b",
          "Unfortunately the internationalisation of 1234567 organisations was misunderstood; mississippi, antidisestablishmentarianism.",
          "Straßenbahnhaltestelle, Überprüfungsausschuss, développement, información, привет мир, 日本語")


class Model:
    """Arrays of a sentencepiece BPE model with byte fallback."""

    def __init__(self, proto: bytes):
        import sentencepiece
        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=proto)
        plain = [i for i in range(lib.vocab_size())
                 if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))]
        pieces = {lib.id_to_piece(i): lib.get_score(i) for i in plain}
        chars = sorted({c for p in pieces for c in p})
        symbol = {s: i for i, s in enumerate([*chars, *(p for p in pieces if len(p) > 1)])}
        self.n = len(symbol)
        # Symbols n+1 .. n+4: characters outside the vocabulary, by UTF-8 length.
        code = np.arange(0x110000)
        self.char = self.n + 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        self.char[[ord(c) for c in chars]] = np.arange(len(chars))
        self.weight = np.ones(self.n + 5, np.int64)
        self.weight[self.n + 1:] = [1, 2, 3, 4]
        for i, c in enumerate(chars):
            if c not in pieces:
                self.weight[i] = len(c.encode())
        scores = sorted(set(pieces.values()), reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        pairs, crossing = {}, set()
        self.leftmost_only = np.zeros(len(scores), bool)
        for p, s in pieces.items():
            for at in range(1, len(p)):
                a, b = p[:at], p[at:]
                crossing.add((symbol[a[-1]], symbol[b[0]]))
                if a in symbol and b in symbol:
                    pairs[symbol[a] * (self.n + 5) + symbol[b]] = (rank[s], symbol[p])
                for part in (a, b):
                    if len(part) > 1 and part in pieces and rank[pieces[part]] >= rank[s]:
                        self.leftmost_only[rank[pieces[part]]] = True
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int32)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], np.int64)
        # Row and column len(chars) stand for every other character.
        self.chars = len(chars)
        self.joins = np.zeros((self.chars + 1, self.chars + 1), bool)
        if crossing:
            self.joins[tuple(np.array(sorted(crossing)).T)] = True

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NO_RANK``: none) and merged symbol of each pair."""
        if not len(self.keys):
            return np.full(len(left), NO_RANK), np.zeros(len(left), np.int64)
        key = left * (self.n + 5) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK), self.merged[at]


@lru_cache(maxsize=4)
def load(proto: bytes) -> Model:
    return Model(proto)


def checked(proto: bytes) -> bytes:
    """``proto`` if the arrays express the model (the library agrees on ``PROBES``)."""
    model = load(proto)
    want = [len(model.library.encode(t, add_bos=False, add_eos=False)) for t in PROBES]
    got = count_texts(model, list(PROBES))
    if want != got.tolist():
        raise ValueError("not a byte-fallback BPE model of the sentencepiece library")
    return proto


def merge_rounds(model: Model, sym: np.ndarray, seq: np.ndarray, n: int) -> np.ndarray:
    """Tokens of each of ``n`` sequences; ``seq`` (ascending) names a symbol's sequence."""
    out = np.zeros(n, np.int64)
    sym = sym.copy()
    rank, to = np.full(len(sym), NO_RANK), np.zeros(len(sym), np.int64)
    near = np.flatnonzero(seq[:-1] == seq[1:])
    rank[near], to[near] = model.lookup(sym[near], sym[near + 1])
    while len(sym):
        first = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
        size = np.diff(np.append(first, len(seq)))
        low = np.minimum.reduceat(rank, first)
        done = low == NO_RANK
        if done.any():
            gone = np.repeat(done, size)
            out += np.bincount(seq[gone], model.weight[sym[gone]], n).astype(np.int64)
            sym, seq, rank, to = sym[~gone], seq[~gone], rank[~gone], to[~gone]
            low, size = low[~done], size[~done]
            if not len(sym):
                break
        each = np.repeat(low, size)
        at = np.flatnonzero(rank == each)
        new_run = np.append(True, np.diff(at) != 1)
        run = np.flatnonzero(new_run)
        odd = (np.arange(len(at)) - run[np.cumsum(new_run) - 1]) & 1
        lead = np.append(True, seq[at][1:] != seq[at][:-1])
        at = at[np.where(model.leftmost_only[each[at]], lead, odd == 0)]
        sym[at] = to[at]
        stays = np.ones(len(sym), bool)
        stays[at + 1] = False
        place = np.cumsum(stays) - 1
        at = place[at]
        sym, seq, rank, to = sym[stays], seq[stays], rank[stays], to[stays]
        again = np.unique(np.concatenate([at, at[at > 0] - 1]))
        rank[again] = NO_RANK
        again = again[again + 1 < len(sym)]
        again = again[seq[again] == seq[again + 1]]
        rank[again], to[again] = model.lookup(sym[again], sym[again + 1])
    return out


def merge_long(model: Model, sym: np.ndarray) -> int:
    """Tokens of one long sequence; its places are held by rank, lowest first."""
    n = len(sym)
    sym = sym.copy()
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    rank, to = np.full(n, NO_RANK), np.zeros(n, np.int64)
    places: dict[int, list[np.ndarray]] = {}
    order: list[int] = []

    def rate(at: np.ndarray) -> None:
        at = at[at >= 0]
        rank[at] = NO_RANK
        at = at[after[at] < n]
        rank[at], to[at] = model.lookup(sym[at], sym[after[at]])
        at = at[rank[at] != NO_RANK]
        at = at[np.argsort(rank[at], kind="stable")]
        for r, group in zip(*_groups(rank[at], at)):
            if r not in places:
                places[r] = []
                heapq.heappush(order, r)
            places[r].append(group)

    def apply(at: np.ndarray) -> None:
        gone = after[at]
        sym[at] = to[at]
        after[at] = after[gone]
        rank[gone] = NO_RANK
        tail = after[at]
        before[tail[tail < n]] = at[tail < n]
        rate(np.unique(np.concatenate([at, before[at]])))

    rate(np.arange(n))
    while order:
        r = heapq.heappop(order)
        held = places.pop(r, None)
        if held is None:
            continue
        if not model.leftmost_only[r]:
            at = np.unique(np.concatenate(held))
            at = at[rank[at] == r]
            if len(at):
                # Places whose right symbol begins the next place overlap: every second one goes.
                new_run = np.append(True, after[at[:-1]] != at[1:])
                run = np.flatnonzero(new_run)
                apply(at[((np.arange(len(at)) - run[np.cumsum(new_run) - 1]) & 1) == 0])
            continue
        heap = np.unique(np.concatenate(held)).tolist()  # ascending, so already a heap
        while heap and not (order and order[0] < r):
            p = heapq.heappop(heap)
            if rank[p] == r:
                apply(np.array([p]))
                for group in places.pop(r, ()):
                    for q in group.tolist():
                        heapq.heappush(heap, q)
        if heap:  # a better rank has come up: the rest of this one waits
            places[r] = [np.array(heap)]
            heapq.heappush(order, r)
    total, p = 0, 0
    while p < n:
        total += int(model.weight[sym[p]])
        p = int(after[p])
    return total


def _groups(sorted_keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    if not len(sorted_keys):
        return [], []
    cut = np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1
    return sorted_keys[np.append(0, cut)].tolist(), np.split(values, cut)


def _members(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and position within it of every symbol of sequences of these sizes."""
    return np.repeat(np.arange(len(size)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def _distinct(sym: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of an equal sequence that represents it, per sequence; distinct representatives)."""
    power = np.full(len(sym) + 1, _ROLL)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    inverse = np.full(len(sym) + 1, np.uint64(pow(int(_ROLL), -1, 1 << 64)))
    inverse[0] = 1
    inverse = np.cumprod(inverse, dtype=np.uint64)
    total = np.zeros(len(sym) + 1, np.uint64)
    np.cumsum(mix(sym.astype(np.uint64)) * power[:-1], dtype=np.uint64, out=total[1:])
    h = (total[start + size] - total[start]) * inverse[start]
    _, one, back = np.unique(h, return_index=True, return_inverse=True)
    like = one[back]
    # Equal hashes are compared symbol by symbol; a sequence that differs stands for itself.
    same = size == size[like]
    mine, step = _members(np.where(same, size, 0))
    differs = sym[start[mine] + step] != sym[start[like[mine]] + step]
    same[np.unique(mine[differs])] = False
    like = np.where(same, like, np.arange(len(start)))
    return like, np.unique(like)


def count_sequences(model: Model, sym: np.ndarray, start: np.ndarray, size: np.ndarray, long: int = LONG) -> np.ndarray:
    """Tokens of each pre-token."""
    out = np.zeros(len(start), np.int64)
    one = size == 1
    out[one] = model.weight[sym[start[one]]]
    for i in np.flatnonzero(size > long):
        out[i] = merge_long(model, sym[start[i]:start[i] + size[i]])
    rest = np.flatnonzero(~one & (size <= long))
    if len(rest):
        like, reps = _distinct(sym, start[rest], size[rest])
        n = size[rest][reps]
        seq, step = _members(n)
        counts = merge_rounds(model, sym[start[rest][reps][seq] + step], seq, len(reps))
        out[rest] = counts[np.searchsorted(reps, like)]
    return out


def count_texts(model: Model, texts: list[str], long: int = LONG, slice_size: int = SLICE) -> np.ndarray:
    """Tokens of each text."""
    normal = [model.library.normalize(t) if t else "" for t in texts]
    offs = np.cumsum([0, *map(len, normal)])
    sym = model.char[np.frombuffer("".join(normal).encode("utf-32-le"), np.uint32)]
    del normal
    out = np.zeros(len(texts), np.int64)
    if not len(sym):
        return out
    kind = np.minimum(sym, model.chars)
    begins = np.append(True, ~model.joins[kind[:-1], kind[1:]])
    begins[offs[offs < len(sym)]] = True
    start = np.flatnonzero(begins)
    size = np.diff(np.append(start, len(sym)))
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(start, start[a] + slice_size)))
        lo, hi = start[a], start[b - 1] + size[b - 1]
        counts = count_sequences(model, sym[lo:hi], start[a:b] - lo, size[a:b], long)
        row = np.searchsorted(offs, start[a:b], "right") - 1
        np.add.at(out, row, counts)
        a = b
    return out


def _grouped(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + limit, "right")))
        yield a, b
        a = b


def _count(proto: bytes, long: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(proto)
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            counts = [count_texts(model, texts.slice(a, b - a).to_pylist(), long) for a, b in _grouped(texts, GROUP_CHARS)]
            total = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(total)],
                                             ["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, spark: SparkSession, model_path: str, limit: int = LIMIT, long: int = LONG) -> DataFrame:
    """Every row with its UTF-8 bytes and tokens: doc_id, n_bytes, n_tokens, over_limit.

    ``model_path`` is read on the driver; the tasks get its bytes (about half a megabyte)."""
    prepare(spark)
    with open(model_path, "rb") as f:
        proto = checked(f.read())
    rows = pick(docs, doc_id="bigint", text="string").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), "text")
    counted = map_batches(rows, _count(proto, long), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
