"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance matrix is never formed. One pass over the vectors multiplies it by a block of
``dimensions x block`` numbers: every task adds up ``Xc' (Xc Q)`` of its own centred rows, Spark
adds the tasks' sums by dimension, and the driver holds nothing but such blocks. A cycle applies a
Chebyshev polynomial in the covariance to the block by its three-term recurrence, one pass a degree.
The polynomial is small on [0, b], b the least Ritz value of the block, and grows fastest beyond,
so that what is not wanted is damped. QR makes the block orthonormal, Rayleigh-Ritz turns it to
eigenvectors of the projected covariance.

Cycles go on until the residuals of all wanted components are below ``NEAR`` of the largest
eigenvalue. Fresh random vectors then take the place of all other vectors of the block, and the
cycles go on until the residuals are below ``TOLERANCE`` and no longer fall, at the precision of the
sums. If any direction had been missed before, the fresh vectors would find it; the result is
certified only if the wanted eigenvalues are the same with them, else all is done again. A spectrum
that never settles is an error.

Entries become whole numbers, and deviations from the mean are taken as exact whole numbers
(n * x - S) before they are divided and multiplied, so centring loses no digits.

Defined results: a null vector and one with a null, NaN or infinite entry is dropped; vectors of
different lengths are an error, as are entries beyond the range of whole numbers; repeated rows
count and are returned each for itself, null keys too; components whose eigenvalue is below
``LEAST`` of the largest cannot be whitened and are left out, so one row, equal rows, empty vectors
and an empty table give an empty result; of equal eigenvalues any base of their space is right.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.llm.storage import stored

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Vectors of the block beside the wanted ones, for each of these; degree of the filter.
GUARDS, DEGREE = 5, 8
#: Residuals, as shares of the largest eigenvalue, at which fresh vectors are put in and at which
#: the cycles may end; how far eigenvalues may differ between the two.
NEAR, TOLERANCE, AGREE = 1e-7, 1e-12, 1e-9
LEAST = 1e-10
GROWTH = 1e10
LEAST_CYCLES, MOST_CYCLES = 2, 500
_WIDE = 1 << 62


def whole_numbers(vector: Column) -> Column:
    """The entries as whole numbers; null if the vector or an entry is null or not finite."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(fine, F.transform(
        vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT))


def _matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy().reshape(len(column), -1)


def _exact(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n * x - S, as whole numbers of any size."""
    widest = max(int(np.abs(x).max(initial=0)) * n, *map(abs, s))
    if widest < _WIDE // 2:
        return x * np.int64(n) - np.array(s, np.int64)
    return x.astype(object) * n - np.array(s, object)


def _sum_rows(batches):
    """Rows and exact sums by dimension of a task."""
    n, sums, sizes = 0, None, set()
    for batch in batches:
        sizes |= set(batch.column("x").value_lengths().to_pylist())
        if len(sizes) > 1:
            raise ValueError(f"vectors differ in length: {sorted(sizes)}")
        if batch.num_rows:
            x = _matrix(batch)
            wide = int(np.abs(x).max(initial=0)) * len(x) >= _WIDE
            part = (x.astype(object) if wide else x).sum(axis=0)
            sums = part.astype(object) + (0 if sums is None else sums)
            n += len(x)
    if sums is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(sums), dtype=np.int32)), pa.array([n] * len(sums), pa.int64()),
             pa.array([Decimal(int(s)) for s in sums], pa.decimal128(38, 0))],
            names=["dim", "n", "s"])


def _entries(sums: np.ndarray) -> pa.RecordBatch:
    """A task's matrix as rows (place, value), for Spark to add up by place."""
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(sums.size, dtype=np.int64)), pa.array(sums.ravel())], names=["at", "v"])


def _added(vectors: DataFrame, rows: Callable, shape: tuple[int, int]) -> np.ndarray:
    """The sum of all tasks' matrices of this shape."""
    sums = vectors.select("x").mapInArrow(rows, "at long, v double").groupBy("at").agg(
        F.sum("v").alias("v")).toArrow()
    out = np.zeros(shape[0] * shape[1])
    out[sums.column("at").to_numpy()] = sums.column("v").to_numpy()
    return out.reshape(shape)


def _product_rows(n: int, s: list[int], q: np.ndarray):
    """A task's share of the covariance times ``q``, and of the covariance's diagonal."""
    def run(batches):
        y = np.zeros((len(s), q.shape[1] + 1))
        for batch in batches:
            if batch.num_rows:
                c = _exact(_matrix(batch), n, s).astype(np.float64) / n
                y[:, :-1] += c.T @ (c @ q)
                y[:, -1] += (c * c).sum(axis=0)
        yield _entries(y)
    return run


class Covariance:
    """The covariance matrix of a stored table of whole-number vectors, as an operator on blocks."""

    def __init__(self, vectors: DataFrame):
        self.vectors = vectors
        found = vectors.select("x").mapInArrow(_sum_rows, "dim int, n long, s decimal(38,0)").groupBy(
            "dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("dim").collect()
        if len({r["n"] for r in found}) > 1:
            raise ValueError("vectors differ in length")
        self.n = found[0]["n"] if found else 0
        self.sums = [int(r["s"]) for r in found]
        self.trace = 0.0
        self.passes = 0

    def times(self, q: np.ndarray) -> np.ndarray:
        """The covariance times a block, in one pass; sets the trace too."""
        y = _added(self.vectors, _product_rows(self.n, self.sums, q),
                   (len(self.sums), q.shape[1] + 1)) / self.n
        self.trace = float(y[:, -1].sum())
        self.passes += 1
        return y[:, :-1]


def _ritz(times: Callable, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Orthonormal Ritz vectors of a block's space, their images and values, largest first."""
    q, _ = np.linalg.qr(block)
    y = times(q)
    h = q.T @ y
    values, w = np.linalg.eigh((h + h.T) / 2)
    w = w[:, ::-1]
    return q @ w, y @ w, values[::-1]


def _filtered(times: Callable, q: np.ndarray, y: np.ndarray, top: float, b: float,
              degree: int) -> np.ndarray:
    """The scaled Chebyshev polynomial for [0, b] in the matrix, times q; y is the matrix times q."""
    half = b / 2
    sigma = first = half / (top - half)
    before, now = q, (y - half * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (times(now) - half * now) * (2 * after / half) - sigma * after * before
        sigma = after
    return now


def _degree(top: float, b: float, most: int) -> int:
    """As high as lets the largest eigenvector grow by at most ``GROWTH`` in a cycle: beyond that
    its rounding errors would drown the other columns."""
    return int(np.clip(math.log(2 * GROWTH) // math.acosh(2 * top / b - 1), 1, most))


def eigenpairs(times: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int = COMPONENTS,
               guards: int = GUARDS, degree: int = DEGREE, seed: int = 0
               ) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues and their unit vectors of a symmetric matrix without negative
    eigenvalues, of which only products with blocks are known."""
    rng = np.random.default_rng(seed)
    wanted = min(wanted, dims)
    size = min(dims, wanted * (1 + guards))
    q, y, values = _ritz(times, rng.standard_normal((dims, size)))
    best, near, since = np.inf, None, 0
    for _ in range(MOST_CYCLES):
        top = float(values[0])
        if top <= 0:
            return values[:wanted] * 0, q[:, :wanted]
        rest = np.linalg.norm(y - q * values, axis=0)[:wanted].max()
        if size == dims:
            return values[:wanted], q[:, :wanted]
        if near is None:
            if rest <= NEAR * top:  # anything missed so far shows in fresh vectors
                near, since, best = values[:wanted].copy(), 0, np.inf
                q = np.hstack([q[:, :wanted], rng.standard_normal((dims, size - wanted))])
                q, y, values = _ritz(times, q)
        elif rest <= TOLERANCE * top and rest > best / 2 and since >= LEAST_CYCLES:
            if np.abs(near - values[:wanted]).max() <= AGREE * top:
                return values[:wanted], q[:, :wanted]
            near = None
        best, since = min(best, rest), since + 1
        b = max(float(values[-1]), 1e-9 * top)
        if b < 0.999 * top:
            y = _filtered(times, q, y, top, b, _degree(top, b, degree))
        q, y, values = _ritz(times, y)
    raise RuntimeError(f"no convergence in {MOST_CYCLES} cycles")


def _moment_rows(n: int, s: list[int], p: np.ndarray):
    """A task's sums of whitened rows and of their products."""
    def run(batches):
        size = p.shape[1]
        sums = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                w = (_exact(_matrix(batch), n, s).astype(np.float64) / n) @ p
                sums[:, :-1] += w.T @ w
                sums[:, -1] += w.sum(axis=0)
        yield _entries(sums)
    return run


def _identity_error(vectors: DataFrame, n: int, s: list[int], p: np.ndarray) -> float:
    size = p.shape[1]
    sums = _added(vectors, _moment_rows(n, s, p), (size, size + 1)) / n
    mean = sums[:, -1]
    return float(np.abs(sums[:, :-1] - np.outer(mean, mean) - np.eye(size)).max())


def _result_rows(n: int, s: list[int], p: np.ndarray, schema: pa.Schema, carry: int):
    """A row for each vector and component."""
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                some = batch.slice(a, 4096)
                d = _exact(_matrix(some), n, s)
                widest = int(np.abs(d).max(initial=0))
                exact = d if widest * widest * len(s) < _WIDE else d.astype(object)
                deviation = [Decimal(int(v)) for v in (exact * exact).sum(axis=1)]
                w = (d.astype(np.float64) / n) @ p
                size = p.shape[1]
                at = pa.array(np.repeat(np.arange(len(w)), size))
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(k).take(at) for k in range(carry)),
                     pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(w))),
                     pa.array(deviation, pa.decimal128(38, 0)).take(at),
                     pa.array(np.ascontiguousarray(w.ravel()))], schema=schema)
    return run


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of every vector that
    remains and every component; deviation as an exact decimal."""
    from pyspark.sql.pandas.types import to_arrow_schema
    vectors = stored(rows.select(F.col(f"`{key}`").alias("key"),
                                 whole_numbers(F.col(f"`{vector}`")).alias("x")).filter(
        "x is not null"), "whole_vectors")
    form = T.StructType([vectors.schema["key"], T.StructField("component", T.IntegerType()),
                         T.StructField("deviation", T.DecimalType(38, 0)),
                         T.StructField("whitened", T.DoubleType())])
    v = Covariance(vectors)
    dims = len(v.sums)
    values, base = eigenpairs(v.times, dims, components) if dims else (np.zeros(0), np.zeros((0, 0)))
    kept = int((values > LEAST * values[0]).sum()) if dims and values[0] > 0 else 0
    if kept:
        p = base[:, :kept] / np.sqrt(values[:kept])
        error = _identity_error(vectors, v.n, v.sums, p)
        made = vectors.mapInArrow(
            _result_rows(v.n, v.sums, p, to_arrow_schema(form), 1), form)
        shares = F.element_at(F.array(*(F.lit(float(e / v.trace)) for e in values[:kept])),
                              F.col("component"))
    else:
        made, error, shares = rows.sparkSession.createDataFrame([], form), 0.0, F.lit(0.0)
    return made.select(F.col("key").alias(key), "component", F.lit(v.n).cast("long").alias("n"),
                       "deviation", "whitened", shares.alias("explained"),
                       F.lit(error).alias("identity_error"))
