"""Embedding whitening: distributed centred covariance, Householder tridiagonalisation,
Sturm-count bisection, inverse iteration, broadcast projection.

Method.  Vectors are quantised to integers (``x = floor(256 c)``) and packed into bytes of
the smallest of 2, 4 or 8 bytes an entry that holds all of a vector, so equal vectors have
equal bytes.  The fit list holds every distinct vector once: map-side partial aggregation
collapses copies before the shuffle, so a vector that a third of all rows repeat is one row
a task.  It is written once to the shared folder and read three times: exact sums (integer
halves, added as decimals), the covariance centred on the exact mean, and the covariance of
the whitened fit list.  Every task sends one d x d partial, and those are added row by row
by Spark: what reaches the driver is d numbers, then d x d numbers, whatever the rows.

On the driver the d x d covariance is reduced to a tridiagonal matrix by Householder
reflections.  The leading eigenvalues are found by bisection on Sturm counts, eigenvectors
by inverse iteration; vectors of a cluster of close eigenvalues are orthogonalised against
each other in every step.  The mean and the d x 4 components go to the tasks with the code
(bounded by the dimension), and the projection is a map over all rows.

``fit`` returns a :class:`Whitening`; ``whiten`` projects any table with it.

Defined cases: rows whose vector is NULL, holds NULL or non-finite entries, or an entry
whose ``x`` leaves the longs, are left out.  So are vectors of another length than the
commonest of the remaining rows (ties: the longest), and empty vectors.  Repeated rows and
NULL ids are rows like any other.  Components without variance (eigenvalue at most
1e-12 of the largest) have no rows, so a table whose vectors are all equal, a single vector
and an empty table give an empty result.  ``deviation`` is exact as a decimal string; as a
long it is NULL where it leaves the longs.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.llm.common import map_batches, pick, prepare, stored

SCALE = 256.0
COMPONENTS = 4
#: Eigenvalues up to this share of the largest count as no variance.
NO_VARIANCE = 1e-12
#: Neighbouring eigenvalues closer than this share of the largest are one cluster.
CLUSTER = 1e-3
_WIDTHS = ((2, np.int16), (4, np.int32), (8, np.int64))


# --- quantised vectors ---------------------------------------------------------------------

def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Usable rows, every row's offsets, and the entries of all rows as one array of x."""
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64)
    lists = column.cast(pa.large_list(pa.float64()))
    valid = pc.is_valid(lists).to_numpy(zero_copy_only=False)
    offs = np.frombuffer(lists.buffers()[1], np.int64)[lists.offset:lists.offset + len(lists) + 1]
    entries = lists.values
    null = pc.is_null(entries).to_numpy(zero_copy_only=False)
    c = pc.fill_null(entries, 0.0).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        q = np.floor(SCALE * c) + 0.0
        bad = null | ~np.isfinite(c) | ~((q >= -2.0 ** 63) & (q < 2.0 ** 63))
    x = np.where(bad, 0.0, q).astype(np.int64)
    wrong = np.append(0, np.cumsum(bad))
    size = np.diff(offs)
    rows = np.flatnonzero(valid & (size > 0) & (wrong[offs[1:]] == wrong[offs[:-1]]))
    return rows, offs, x


def _packed(x: np.ndarray) -> bytes:
    top = max(int(x.max()), -int(x.min()) - 1)
    for width, kind in _WIDTHS:
        if top < 1 << (8 * width - 1):
            return bytes([width]) + x.astype(kind).tobytes()
    raise AssertionError("longs hold every x")


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, offs, x = _vectors(batch.column("embedding"))
        packed = [_packed(x[offs[i]:offs[i + 1]]) for i in rows]
        yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()),
                                          pa.array([offs[i + 1] - offs[i] for i in rows], pa.int32()),
                                          pa.array(np.ones(len(rows), np.int64))], ["v", "d", "n"])


def _unpacked(column: pa.Array, d: int) -> np.ndarray:
    """Rows of longs."""
    out = np.empty((len(column), d), np.int64)
    packed = column.to_pylist()
    width = np.array([p[0] for p in packed], np.int64)
    for w, kind in _WIDTHS:
        at = np.flatnonzero(width == w)
        if len(at):
            out[at] = np.frombuffer(b"".join(packed[i][1:] for i in at), kind).reshape(len(at), d)
    return out


# --- distributed sums ----------------------------------------------------------------------

def _halves(d: int):
    """Exact column sums of a task, as sums of the high and low 32 bits."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            x = _unpacked(batch.column("v"), d)
            n += len(x)
            high += (x >> 32).sum(0)
            low += (x & 0xFFFFFFFF).sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n)),
                                              pa.array(high), pa.array(low)], ["i", "n", "high", "low"])
    return run


def _scatter(d: int, mean: np.ndarray, project: np.ndarray | None):
    """Sums of a task over its centred rows y: rows of y^T y, and in row -1 the sum of y and
    the number of rows.  With ``project`` y is the projection of the centred row."""
    k = d if project is None else project.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            y = _unpacked(batch.column("v"), d) - mean
            y = y if project is None else y @ project
            n += len(y)
            first += y.sum(0)
            second += y.T @ y
        if n:
            rows = np.vstack([np.append(first, n)[None], np.column_stack([second, np.zeros(k)])])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, k, dtype=np.int32)),
                 pa.array(list(rows), pa.list_(pa.float64()))], ["i", "row"])
    return run


def _covariance(fit_list: DataFrame, d: int, mean: np.ndarray, project: np.ndarray | None = None) -> np.ndarray:
    """Covariance (divisor n) of the fit list, centred on ``mean`` before multiplying; what
    rounding leaves of the centred rows' mean is taken off."""
    k = d if project is None else project.shape[1]
    partial = map_batches(fit_list.select("v"), _scatter(d, mean, project), "i int, row array<double>")
    added = partial.select("i", F.posexplode("row").alias("j", "s")).groupBy("i", "j").agg(F.sum("s").alias("s"))
    table = np.zeros((k + 1, k + 1))
    for r in added.collect():  # (k + 1)^2 numbers at most
        table[r.i + 1, r.j] = r.s
    n, first = table[0, k], table[0, :k]
    second = table[1:, :k]
    return (second + second.T) / (2 * n) - np.outer(first / n, first / n)


# --- eigenvalues of a symmetric matrix -------------------------------------------------------

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Householder reduction: (diagonal, off-diagonal, reflection vectors)."""
    a = np.array(matrix, float)
    n = len(a)
    mirrors = []
    for j in range(n - 2):
        v = a[j + 1:, j].copy()
        norm = np.sqrt(v @ v)
        if norm == 0:
            mirrors.append(np.zeros_like(v))
            continue
        v[0] += norm if v[0] >= 0 else -norm
        v /= np.sqrt(v @ v)
        mirrors.append(v)
        p = a[j + 1:, j + 1:] @ v
        w = p - (v @ p) * v
        a[j + 1:, j + 1:] -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[j + 1, j] -= 2 * v[0] * (v @ a[j + 1:, j])
    return a.diagonal().copy(), a.diagonal(-1).copy(), mirrors


def mirrored(vector: np.ndarray, mirrors: list[np.ndarray]) -> np.ndarray:
    """A vector of the tridiagonal basis in the original one."""
    out = vector.copy()
    for j in reversed(range(len(mirrors))):
        v = mirrors[j]
        out[j + 1:] -= 2 * (v @ out[j + 1:]) * v
    return out


def sturm_count(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eigenvalues below each value of ``at``: the negative terms of the Sturm sequence."""
    tiny = np.finfo(float).tiny * max(1.0, float(np.abs(off).max(initial=0)) ** 2)
    q = diag[0] - at
    below = (q < 0).astype(int)
    for d, b in zip(diag[1:], off):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = d - at - b * b / q
        below += q < 0
    return below


def leading_eigenvalues(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection to the last bit."""
    n = len(diag)
    radius = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    lo = np.full(k, (diag - radius).min())
    hi = np.full(k, (diag + radius).max())
    lo, hi = lo - 1e-9 * (1 + np.abs(lo)), hi + 1e-9 * (1 + np.abs(hi))
    target = n - np.arange(k)  # the i-th largest is the target-th smallest
    while True:
        mid = (lo + hi) / 2
        if np.all((mid <= lo) | (mid >= hi)):
            return mid
        enough = sturm_count(diag, off, mid) >= target
        hi, lo = np.where(enough, mid, hi), np.where(enough, lo, mid)


def _solve(diag: np.ndarray, off: np.ndarray, shift: float, rhs: np.ndarray, tiny: float) -> np.ndarray:
    """(T - shift) x = rhs by elimination with partial pivoting."""
    n = len(diag)
    main, up, up2, x = diag - shift, np.append(off, 0.0), np.zeros(n), rhs.copy()
    for i in range(n - 1):
        low = off[i]
        if abs(main[i]) >= abs(low):
            f = low / main[i] if main[i] else 0.0
            main[i + 1] -= f * up[i]
            x[i + 1] -= f * x[i]
        else:
            f = main[i] / low
            main[i], main[i + 1], up[i] = low, up[i] - f * main[i + 1], main[i + 1]
            up2[i], up[i + 1] = up[i + 1], -f * up[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i] - f * x[i + 1]
    for i in reversed(range(n)):
        s = x[i] - (up[i] * x[i + 1] if i + 1 < n else 0) - (up2[i] * x[i + 2] if i + 2 < n else 0)
        x[i] = s / (main[i] if abs(main[i]) > tiny else tiny)
    return x


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k leading eigenvalues (falling) of a covariance matrix and their unit eigenvectors
    (columns), without those that count as no variance."""
    top = float(np.abs(matrix).max(initial=0)) or 1.0
    diag, off, mirrors = tridiagonal(matrix / top)
    values = leading_eigenvalues(diag, off, k)
    values = values[values > NO_VARIANCE * max(float(values[0]), 0.0)]
    norm = float(values.max(initial=np.finfo(float).tiny))
    tiny = np.finfo(float).eps * norm
    rng = np.random.default_rng(len(diag))
    found: list[np.ndarray] = []
    for i, e in enumerate(values):
        # Close eigenvalues before this one: their vectors are taken out in every step.
        begin = i
        while begin and values[begin - 1] - values[begin] <= CLUSTER * norm:
            begin -= 1
        x = rng.standard_normal(len(diag))
        for _ in range(6):
            x = _solve(diag, off, e, x / np.sqrt(x @ x), tiny)
            x /= np.abs(x).max()
            for _ in range(2):
                for v in found[begin:i]:
                    x -= (v @ x) * v
        found.append(x / np.sqrt(x @ x))
    vectors = np.column_stack([np.zeros((len(diag), 0)), *[mirrored(v, mirrors) for v in found]])
    return values * top, vectors / np.sqrt((vectors ** 2).sum(0))


# --- fit and projection ----------------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """``n`` fitted vectors, their exact sums, leading eigenvalues, unit components
    (columns), trace of the covariance and the identity error of the whitened fit list."""
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fit(vectors: DataFrame, spark: SparkSession, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct quantised vectors of ``embedding``; None if nothing varies."""
    prepare(spark)
    packed = map_batches(pick(vectors, embedding="array<double>"), _pack, "v binary, d int, n bigint")
    distinct = stored(packed.groupBy("v", "d").agg(F.sum("n").alias("n")), spark, "whitening-fit")
    size = distinct.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if size is None:
        return None
    d = size["d"]
    fit_list = distinct.where(F.col("d") == d)
    halves = map_batches(fit_list.select("v"), _halves(d), "i int, n bigint, high bigint, low bigint")
    sums = (halves.groupBy("i").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")])
            .orderBy("i").collect())  # one row a dimension
    n = int(sums[0]["n"])
    exact = tuple(int(r["high"]) * (1 << 32) + int(r["low"]) for r in sums)
    mean = np.array([s / n for s in exact])
    covariance = _covariance(fit_list, d, mean)
    values, axes = leading_components(covariance, min(components, d))
    if not len(values):
        return None
    found = Whitening(n, exact, values, axes, float(np.trace(covariance)), 0.0)
    white = _covariance(fit_list, d, mean, found.projection)
    error = float(np.abs(white - np.eye(len(values))).max())
    return Whitening(n, exact, values, axes, found.trace, error)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int]:
    """Exact sum of (n x - S)^2 per row."""
    top = n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, sums))
    if top * top * len(sums) < 1 << 63:
        y = n * x - np.array(sums, np.int64)
        return (y * y).sum(1).tolist()
    y = n * x.astype(object) - np.array(sums, object)
    return [int(s) for s in (y * y).sum(1)]


def _project(w: Whitening):
    d, k = len(w.sums), len(w.values)
    mean, projection = w.mean, w.projection

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, offs, x = _vectors(batch.column("embedding"))
            rows = rows[offs[rows + 1] - offs[rows] == d]
            x = x[offs[rows][:, None] + np.arange(d)]
            white = (x - mean) @ projection
            exact = _deviations(x, w.n, w.sums)
            ids = batch.column("vec_id").take(pa.array(np.repeat(rows, k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                 pa.array([str(e) for e in exact for _ in range(k)], pa.string()), pa.array(white.ravel())],
                ["vec_id", "component", "deviation_exact", "whitened"])
    return run


WHITENED = "vec_id bigint, component int, deviation_exact string, whitened double"


def whiten(vectors: DataFrame, spark: SparkSession, w: Whitening | None) -> DataFrame:
    """Every usable row and component: vec_id, component, n, deviation, whitened, explained,
    identity_error, deviation_exact."""
    prepare(spark)
    if w is None:
        rows = spark.createDataFrame([], WHITENED)
    else:
        rows = map_batches(pick(vectors, vec_id="bigint", embedding="array<double>"), _project(w), WHITENED)
    shares = [] if w is None else [float(v / w.trace) for v in w.values]
    explained = F.element_at(F.array(*[F.lit(s) for s in shares]), F.col("component")) if shares else F.lit(None)
    return rows.select(
        "vec_id", "component", F.lit(w.n if w else 0).cast("bigint").alias("n"),
        F.expr("try_cast(deviation_exact AS bigint)").alias("deviation"), "whitened",
        explained.cast("double").alias("explained"),
        F.lit(w.identity_error if w else 0.0).cast("double").alias("identity_error"), "deviation_exact")


def whiten_table(vectors: DataFrame, spark: SparkSession, components: int = COMPONENTS) -> DataFrame:
    """Fit on the table and project its rows."""
    return whiten(vectors, spark, fit(vectors, spark, components))
