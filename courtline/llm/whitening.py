"""Embedding whitening with eigenpairs by FEAST contour integration.

Spark turns vectors into integers, keeps each distinct one once as the fit
list, and adds up its exact sums and its centred covariance.  The covariance, as
large as the vector length squared, is split on the driver: inertia counts of
the shifted matrix lay out intervals that hold the wanted eigenvalues, the
quadrature of complex shifted solves around an interval projects a few vectors
onto its eigenspace, Rayleigh-Ritz extracts the pairs, and the inertia count
says that none is missed.  Spark then projects every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from courtline.llm.common import stored

SCALE, OFFSET = 64.0, 1_000_000
# Scaled entries beyond this are cut to it, so that all sums stay exact.
MOST_SCALED = 1 << 40
# Quadrature points on the upper half of a contour; the lower half is their mirror image.
POINTS = 16
# Eigenvalues an interval should hold at most, and rounds of subspace iteration.
PER_INTERVAL, MOST_ROUNDS = 8, 30
# Residual, relative to the matrix, below which pairs that improve no more are taken.
SETTLED = 1e-13
# Eigenvalues below this share of the greatest one are rounding of zero and have no component.
ZERO = 1e-12


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a symmetric matrix after Householder reflections."""
    a = a.copy()
    d = len(a)
    for j in range(d - 2):
        x = a[j + 1:, j].copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x[0] += norm if x[0] >= 0 else -norm
        x /= np.linalg.norm(x)
        rest = a[j + 1:, j + 1:]
        p = rest @ x
        q = 2 * (p - (x @ p) * x)
        rest -= np.outer(x, q) + np.outer(q, x)
        col = a[j + 1:, j]
        col -= 2 * (x @ col) * x
        a[j, j + 1:] = col
    return np.diag(a).copy(), np.diag(a, -1).copy()


def inertia(diagonal: np.ndarray, off: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie above ``shift``: positive pivots of the factored shifted matrix."""
    above, pivot = 0, 1.0
    tiny = np.finfo(float).tiny
    for i, x in enumerate(diagonal.tolist()):
        pivot = x - shift - (off[i - 1] ** 2 / pivot if i else 0.0)
        if pivot == 0:
            pivot = -tiny ** 0.5
        above += pivot > 0
    return above


def intervals(diagonal: np.ndarray, off: np.ndarray, low: float, high: float, k: int) -> list[tuple[float, float, int]]:
    """(from, to, eigenvalues inside), falling, that hold at least the ``k`` greatest eigenvalues above ``low``."""
    out: list[tuple[float, float, int]] = []
    todo = [(low, high, inertia(diagonal, off, low), 0)]
    got = 0
    while todo and got < k:
        a, b, above_a, above_b = todo.pop()
        inside = above_a - above_b
        if not inside:
            continue
        if inside > PER_INTERVAL and b - a > 1e-10 * high:
            mid = (a + b) / 2
            above = inertia(diagonal, off, mid)
            todo += [(a, mid, above_a, above), (mid, b, above, above_b)]
            continue
        out.append((a, b, inside))
        got += inside
    return out


def _ritz(a: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz pairs of ``a`` in the space of the columns of ``q``, eigenvalues rising."""
    u, s, _ = np.linalg.svd(q, full_matrices=False)
    u = u[:, s > s[0] * 1e-14] if len(s) and s[0] > 0 else u[:, :0]
    small = u.T @ a @ u
    values, turn = np.linalg.eigh((small + small.T) / 2)
    return values, u @ turn


def feast(a: np.ndarray, low: float, high: float, inside: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``inside`` eigenpairs of a symmetric matrix with low < eigenvalue <= high; their number is known from inertia.

    ArithmeticError where the pairs found do not settle or are not that many.
    """
    d = len(a)
    centre, radius = (low + high) / 2, (high - low) / 2
    x, w = np.polynomial.legendre.leggauss(POINTS)
    turn = np.exp(1j * np.pi * (x + 1) / 2)
    eye = np.eye(d)
    solves = [np.linalg.inv((centre + radius * t) * eye - a) for t in turn]
    norm = max(np.abs(a).sum(axis=1).max(), np.finfo(float).tiny)
    size = min(d, 2 * inside + 8)
    while True:
        y = np.random.default_rng(seed).normal(size=(d, size))
        best: tuple[float, np.ndarray, np.ndarray] | None = None
        stale = 0
        for _ in range(MOST_ROUNDS):
            projected = sum((wi / 2) * radius * np.real(t * (s @ y)) for wi, t, s in zip(w, turn, solves))
            values, y = _ritz(a, projected)
            chosen = (values > low) & (values <= high)
            wrong = float(np.abs(a @ y[:, chosen] - y[:, chosen] * values[chosen]).max(initial=0.0)) / norm
            if chosen.sum() == inside and (best is None or wrong < best[0]):
                best, stale = (wrong, values[chosen], y[:, chosen]), 0
            else:
                stale += 1
            if best is not None and (best[0] <= 1e-15 or best[0] <= SETTLED and stale >= 2):
                return best[1], best[2]
        if size == d:
            raise ArithmeticError(f"contour around ({low}, {high}] did not give its {inside} eigenpairs")
        size = min(d, 2 * size)  # eigenvalues crowd outside the contour: a larger space tells them apart


def top_eigenpairs(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest eigenvalues, falling, and unit eigenvectors in columns; fewer where the rest is zero.

    Each vector's greatest entry is positive.  The pairs of all intervals go
    through one last Rayleigh-Ritz step together, which makes them orthogonal
    across intervals.
    """
    none = np.zeros(0), np.zeros((len(cov), 0))
    size = np.abs(cov).sum(axis=1).max(initial=0.0)
    if size == 0:
        return none
    a = cov / size
    diagonal, off = tridiagonal(a)
    high = 1.0 + 1e-9
    # The greatest eigenvalue, to two digits, sets what counts as zero.
    low, top = 0.0, high
    while top - low > 0.01 * top:
        mid = (low + top) / 2
        low, top = (mid, top) if inertia(diagonal, off, mid) else (low, mid)
    spans = intervals(diagonal, off, ZERO * top, top, k)
    if not spans:
        return none
    parts = [feast(a, lo, hi, n) for lo, hi, n in spans]
    values, vectors = _ritz(a, np.concatenate([v for _, v in parts], axis=1))
    values, vectors = values[::-1][:k] * size, vectors[:, ::-1][:, :k]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors * sign


@dataclass
class Whitening:
    """Whitening of vectors of one length: fit list size, exact sums, trace, and the components."""
    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n; whole and fractional part of the mean are taken off one by one, so nothing cancels."""
        whole = self.sums // self.n
        return (x - whole) - (self.sums - whole * self.n) / self.n

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of squares of n x - S, exact; None beyond 63 bits."""
        whole = self.sums // self.n
        step, rest = x - whole, self.sums - whole * self.n
        if not len(x):
            return []
        most = (float(np.abs(step).max()) + 1) * self.n
        if most * most * x.shape[1] < 2.0 ** 62:
            return ((self.n * step - rest) ** 2).sum(axis=1).tolist()
        exact = [sum(v * v for v in row) for row in (self.n * step.astype(object) - rest.astype(object)).tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), d)


def _partial_sums(x: DataFrame, width: int, add) -> np.ndarray:
    """Sum over all rows of ``add(matrix)``, a flat array of ``width``: one row a task, added up by position in Spark."""
    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for f in frames:
            column = f.column(0)
            if len(column):
                part = add(column)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["v"])

    got = x.select("x").mapInArrow(batches, "v array<double>").select(F.posexplode("v").alias("i", "v")) \
        .groupBy("i").agg(F.sum("v").alias("v")).toPandas()  # ``width`` rows at most
    out = np.zeros(width)
    out[got["i"].to_numpy(dtype=np.int64)] = got["v"].to_numpy()
    return out


def integer_vectors(df: DataFrame, vector: str, scale: float = SCALE, offset: int = OFFSET):
    """Column of floor(scale * c) + offset per entry as array<long>; null where the vector is null or an entry is null or not finite."""
    sound = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    most = F.lit(float(MOST_SCALED))
    return F.when(F.coalesce(sound, F.lit(False)), F.transform(
        vector, lambda c: F.floor(F.greatest(-most, F.least(most, c.cast("double") * F.lit(scale)))).cast("long") + F.lit(offset)))


def fit(x: DataFrame, d: int, k: int) -> Whitening:
    """Whitening by ``k`` components of the distinct rows ``x`` (arrays of ``d`` longs), which must be stored."""
    n = x.count()
    exact = x.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).collect()
    sums = np.zeros(d, np.int64)
    for i, s in exact:  # one row a dimension
        sums[i] = int(s)
    model = Whitening(n, sums, 0.0, np.zeros(0), np.zeros((d, 0)))
    upper = np.triu_indices(d)

    def products(column: pa.Array) -> np.ndarray:
        c = model.centred(_matrix(column, d))
        return (c.T @ c)[upper]

    cov = np.zeros((d, d))
    cov[upper] = _partial_sums(x, len(upper[0]), products) / n
    cov = cov + np.triu(cov, 1).T
    model.trace = float(np.trace(cov))
    model.values, model.vectors = top_eigenpairs(cov, k)
    m = len(model.values)
    if m:
        def moments(column: pa.Array) -> np.ndarray:
            y = model.project(_matrix(column, d))
            return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

        got = _partial_sums(x, m + m * m, moments) / n
        white = got[m:].reshape(m, m) - np.outer(got[:m], got[:m])
        model.identity_error = float(np.abs(white - np.eye(m)).max())
    return model


def whiten(df: DataFrame, *, key: str = "vec_id", vector: str = "embedding", k: int = 16, scale: float = SCALE,
           offset: int = OFFSET) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row per vector and component.

    Vectors that are null or hold a null or non-finite entry have no rows.
    Entries become ``floor(scale * c) + offset``, cut to ``MOST_SCALED`` before
    the offset.  Each length of vectors is whitened on its own, by the distinct
    vectors of that length (the fit list); repeated rows and null keys get their
    rows each but count once in the fit.  Components are numbered from 1 by
    falling eigenvalue, ``k`` at most; where all that is left of the variance is
    zero there are none, so empty vectors, a single distinct vector and an
    empty table give no rows.  ``deviation`` is null beyond 63 bits.  Other columns
    are not read.  Memory: the covariance of one length, on the driver and once
    a task.  One pass stores the integers, further ones read them.
    """
    spark = df.sparkSession
    src = df.select(F.col(key).alias("key"), integer_vectors(df, vector, scale, offset).alias("x"))
    rows = stored(src.filter("x IS NOT NULL AND size(x) > 0"), "whiten-rows")
    distinct = stored(rows.select("x").distinct(), "whiten-fit")
    schema = StructType([StructField(key, src.schema["key"].dataType), StructField("component", IntegerType()), StructField("n", LongType()),
                         StructField("deviation", LongType()), StructField("whitened", DoubleType()), StructField("explained", DoubleType()),
                         StructField("identity_error", DoubleType())])
    out = spark.createDataFrame([], schema)
    lengths = [d for (d,) in distinct.select(F.size("x").alias("d")).distinct().orderBy("d").collect()]
    for d in lengths:
        model = fit(distinct.filter(F.size("x") == d), d, k)
        if len(model.values):
            out = out.unionAll(_project(rows.filter(F.size("x") == d), model, schema))
    return out


def _project(rows: DataFrame, model: Whitening, schema: StructType) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.values)
        for f in frames:
            x = _matrix(f.column(1), len(m.sums))
            at = np.repeat(np.arange(len(x)), k)
            size = len(at)
            yield pa.RecordBatch.from_arrays(
                [f.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(size, m.n)), pa.array(m.deviations(x), pa.int64()).take(pa.array(at)),
                 pa.array(m.project(x).ravel()), pa.array(np.tile(m.values / m.trace, len(x))),
                 pa.array(np.full(size, m.identity_error))], names=schema.names)

    return rows.mapInArrow(batches, schema)
