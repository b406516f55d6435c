"""Array helpers used inside tasks: words, word hashes and n-gram hashes of many texts at
once, without a Python loop over words.

A batch of texts is one byte array plus offsets.  Every helper works on chunks of about
``CHUNK_BYTES``; a longer single text is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit finaliser (shift-xor-multiply rounds), seeded."""
    z = h + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & _MASK)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def byte_values(fold_ascii: bool) -> np.ndarray:
    """A random 64-bit value per byte; A-Z share the values of a-z when folding."""
    values = mix(np.arange(256, dtype=np.uint64), 11)
    if fold_ascii:
        values[65:91] = values[97:123]
    return values


def alnum_or_high() -> np.ndarray:
    """Word bytes: 0-9, A-Z, a-z and everything from 0x7F up that is not DEL's range end
    ({|}~ excluded): the class [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] after A-Z lower-casing."""
    ok = np.zeros(256, bool)
    ok[48:58] = ok[65:91] = ok[97:123] = ok[128:] = True
    return ok


def non_space() -> np.ndarray:
    """Word bytes: the class [^\\x20\\x09-\\x0D]."""
    ok = np.ones(256, bool)
    ok[[32, 9, 10, 11, 12, 13]] = False
    return ok


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "b" not in _powers or len(_powers["b"]) < n:
        size = max(n, 2 * CHUNK_BYTES)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("b", _BASE), ("i", inverse)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["b"][:n], _powers["i"][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; NULL is an empty text."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offs


def chunks(offs: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (one row at least)."""
    start, n = 0, len(offs) - 1
    while start < n:
        stop = int(np.searchsorted(offs, offs[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop
        start = stop


class Words:
    """Words of a chunk: ``doc`` (row in the chunk), ``start``/``end`` (bytes in the
    chunk), ``hash`` (64 bits) and ``first`` (index of each row's first word, plus end)."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, is_word: np.ndarray, values: np.ndarray):
        inside = is_word[data]
        begin, last = inside.copy(), inside.copy()
        if len(data):
            begin[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            cut = offs[(offs > 0) & (offs < len(data))]
            begin[cut] = inside[cut]
            last[cut - 1] = inside[cut - 1]
        self.data = data
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, offs)
        self.doc = np.repeat(np.arange(len(offs) - 1), np.diff(self.first))
        power, inverse = _power(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * power[:-1], dtype=np.uint64, out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * inverse[self.start])

    def __len__(self) -> int:
        return len(self.start)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def words(column: pa.Array, is_word: np.ndarray, values: np.ndarray,
          limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) for each chunk of the column."""
    raw, offs = text_bytes(column)
    for a, b in chunks(offs, limit):
        yield a, b, Words(raw[offs[a]:offs[b]], offs[a:b + 1] - offs[a], is_word, values)


def grams(h: np.ndarray, n: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Polynomial hash of every ``n`` consecutive values (by doubling); one per start."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out, out_n, cur, cur_n = None, 0, h, 1
    while True:
        if n & cur_n:
            if out is None:
                out, out_n = cur, cur_n
            else:
                size = len(h) - out_n - cur_n + 1
                out = out[:size] * np.uint64(pow(base, cur_n, 1 << 64)) + cur[out_n:out_n + size]
                out_n += cur_n
        if out_n == n:
            return out
        size = len(h) - 2 * cur_n + 1
        cur = cur[:size] * np.uint64(pow(base, cur_n, 1 << 64)) + cur[cur_n:cur_n + size]
        cur_n *= 2


def sliding(values: np.ndarray, n: int, op: np.ufunc) -> np.ndarray:
    """Minimum or maximum of every ``n`` consecutive values (by doubling)."""
    if len(values) < n:
        return values[:0]
    cur, size = values, 1
    while 2 * size <= n:
        cur = op(cur[:-size], cur[size:])
        size *= 2
    return op(cur[:len(values) - n + 1], cur[n - size:n - size + len(values) - n + 1])


def sets_of(row: np.ndarray, h: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes per row: (row, hash, multiplicity, offsets by row); ``row`` ascends."""
    order = np.lexsort((h, row))
    r, v = row[order], h[order]
    new = np.ones(len(v), bool)
    new[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(v)))
    r, v = r[at], v[at]
    return r, v, count, np.searchsorted(r, np.arange(rows + 1))
