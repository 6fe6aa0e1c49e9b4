"""Embedding whitening: leading components by FEAST contour integration.

Spark computes the covariance of the distinct quantised vectors: sums, then
products of centred vectors, added up in each task first. The eigenproblem
has the size of a vector, not of the table:

1. Inertia counts (signs in the LDL' form of the shifted covariance, brought
   to three diagonals once) place cuts into wide gaps of the spectrum, with
   a known number of eigenvalues between two cuts.
2. Each interval is a Spark task of its own: quadrature of (zI - V)^-1 Y along
   a circle around it projects random columns onto its eigenspace,
   Rayleigh-Ritz extracts the components, and this is repeated until every
   residual is small and as many are found as the inertia counts say.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from .common import stored

STEPS = 256          # of one unit of an embedding's entry
COMPONENTS = 4
NODES = 12           # quadrature points on the upper half of the circle
PER_INTERVAL = 16    # components that one interval may hold
ROUNDS = 30
CLOSE = 1e-9         # eigenvalues nearer than this, by the matrix's size, aren't parted by a cut
# Entries past this size can't become a 64-bit integer.
LARGEST = float(1 << 54)


class Model(NamedTuple):
    n: int                    # distinct vectors
    sums: list[int]           # per dimension
    values: np.ndarray        # eigenvalues, falling
    vectors: np.ndarray       # one component per row
    trace: float


# --- the eigenproblem -------------------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a matrix similar to the symmetric ``a`` (Householder)."""
    a = a.copy()
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1:, k]
        if not np.any(x[1:]):
            continue
        v = x.copy()
        v[0] += np.copysign(np.linalg.norm(x), x[0])
        v /= np.linalg.norm(v)
        sub = a[k + 1:, k + 1:]
        w = sub @ v
        w -= (v @ w) * v
        sub -= 2 * np.outer(v, w) + 2 * np.outer(w, v)
        a[k + 1:, k] -= 2 * v * (v @ x)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(diag: np.ndarray, off: np.ndarray, shift: float) -> int:
    """Eigenvalues over ``shift``: positive pivots in the LDL' form of T - shift I."""
    tiny = np.finfo(float).tiny ** 0.5
    above, pivot = 0, 1.0
    for k, x in enumerate(diag):
        pivot = x - shift - (off[k - 1] ** 2 / pivot if k else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        above += pivot > 0
    return int(above)


def _nth(diag: np.ndarray, off: np.ndarray, k: int, low: float, high: float) -> float:
    """About the ``k``-th largest eigenvalue, by halving with inertia counts."""
    for _ in range(60):
        mid = (low + high) / 2
        if count_above(diag, off, mid) >= k:
            low = mid
        else:
            high = mid
    return (low + high) / 2


def intervals(v: np.ndarray, components: int) -> list[tuple[float, float, int]]:
    """(low, high, count): intervals that hold the leading eigenvalues, cut in wide gaps.

    Eigenvalues that can't be told from zero are in none. Ties, and
    eigenvalues nearly tied, stay in one interval.
    """
    diag, off = tridiagonal(v)
    d = len(v)
    reach = np.abs(v).sum(axis=1).max()
    top = reach * 1.001
    zero = d * np.finfo(float).eps * reach
    rank = count_above(diag, off, zero)
    cuts, done = [], 0
    while done < min(components, rank):
        first = min(done + min(components - done, PER_INTERVAL), rank)
        near, best = [_nth(diag, off, first, 0.0, top)], None
        for k in range(first + 1, rank + 2):
            near.append(_nth(diag, off, k, 0.0, top) if k <= rank else zero)
            gaps = -np.diff(near)
            best = int(np.argmax(gaps))
            if len(gaps) >= PER_INTERVAL // 2 and gaps[best] > CLOSE * reach:
                break
        low = (near[best] + near[best + 1]) / 2
        held = count_above(diag, off, low)
        cuts.append((float(low), float(cuts[-1][0] if cuts else top), int(held - done)))
        done = held
    return cuts


def feast(v: np.ndarray, low: float, high: float, count: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues in (low, high), rising, and their unit vectors as columns."""
    d = len(v)
    centre, radius = (low + high) / 2, (high - low) / 2
    x, w = np.polynomial.legendre.leggauss(NODES)
    turn = radius * np.exp(1j * np.pi * (x + 1) / 2)
    size = np.linalg.norm(v)
    width = min(d, 2 * count + 8)
    rng = np.random.default_rng(seed)
    y = rng.standard_normal((d, width))
    while True:
        for _ in range(ROUNDS):
            q = np.zeros_like(y)
            for t, weight in zip(turn, w):
                q += weight / 2 * (t * np.linalg.solve((centre + t) * np.eye(d) - v, y)).real
            q, _ = np.linalg.qr(q)
            values, small = np.linalg.eigh(q.T @ v @ q)
            y = q @ small
            inside = (values > low) & (values < high)
            left = np.linalg.norm(v @ y - y * values, axis=0)
            found = inside & (left <= 16 * np.finfo(float).eps * d ** 0.5 * size)
            if found.sum() == count == inside.sum():
                return values[found], y[:, found]
        if width == d:
            raise ArithmeticError(f"{count} eigenvalues between {low} and {high}, {found.sum()} found")
        width = min(d, 2 * width)
        y = np.hstack([y, rng.standard_normal((d, width - y.shape[1]))])


def components_of(spark: SparkSession, v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading eigenvalues, falling, and vectors, as rows; one Spark task for each interval.

    ``v`` goes to the tasks: the square of a vector's length, whatever the
    rows. Components without variance are left out. The largest entry of
    each vector is positive.
    """
    d = len(v)
    if not d or not np.trace(v) > 0:
        return np.zeros(0), np.zeros((0, d))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                values, vectors = feast(v, r["low"], r["high"], r["count"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values), pa.array(vectors.T.tolist(), pa.list_(pa.float64()))], names=["e", "vector"])

    cuts = intervals(v, components)
    if not cuts:
        return np.zeros(0), np.zeros((0, d))
    work = spark.createDataFrame(cuts, "low double, high double, count int").repartition(len(cuts), "low")
    got = sorted(work.mapInArrow(solve, "e double, vector array<double>").collect(), key=lambda r: -r.e)
    got = got[:components]
    vectors = np.array([r.vector for r in got]).reshape(len(got), d)
    most = np.abs(vectors).argmax(axis=1)
    vectors *= np.sign(vectors[np.arange(len(got)), most])[:, None]
    return np.array([r.e for r in got]), vectors


# --- the data ---------------------------------------------------------------

def quantised(vec: Column) -> Column:
    """floor(256 c) of every entry as longs; null if an entry is null, not finite or past 64 bits."""
    c = F.transform(vec, lambda e: e.cast("double"))
    fine = F.forall(c, lambda e: F.coalesce(F.abs(e) < LARGEST, F.lit(False)))
    return F.when(fine, F.transform(c, lambda e: F.floor(e * STEPS).cast("long")))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: in 64 bits where they hold it, else as Python integers."""
    most = max((abs(int(x.min())), abs(int(x.max())))) if x.size else 0
    if n * most + max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def _deviation(z: np.ndarray) -> list:
    """Sums of squares, exact; None past 64 bits."""
    most = max((abs(int(z.min())), abs(int(z.max())))) if z.size else 0
    if z.dtype != object and most * most * z.shape[1] < 1 << 63:
        return (z * z).sum(axis=1).tolist()
    totals = (z.astype(object) ** 2).sum(axis=1).tolist()
    return [t if t < 1 << 63 else None for t in totals]


def _moments(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Distinct vectors and the exact sums of their entries."""
    sums = [F.sum(F.col("x")[i].cast("decimal(38,0)")) for i in range(d)]
    n, *got = fit.agg(F.count(F.lit(1)), *sums).first() if d <= 128 else _long_moments(fit)
    return n, [int(s or 0) for s in got]


def _long_moments(fit: DataFrame) -> list:
    """The same for long vectors: one group for each dimension."""
    rows = (fit.select(F.posexplode("x").alias("i", "v")).groupBy("i")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
            .orderBy("i").collect())
    return [rows[0].n if rows else 0, *[r.s for r in rows]]


def covariance(fit: DataFrame, d: int, n: int, sums: list[int]) -> np.ndarray:
    """Of the fit list, divisor n, centred before multiplying; each task adds up its own rows first."""
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            z = (_centred(_matrix(batch.column(0), d), n, sums) / n).astype(float)
            total += z.T @ z
        i = np.repeat(np.arange(d), d)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i), pa.array(np.tile(np.arange(d), d)), pa.array(total.ravel())], names=["i", "j", "v"])

    rows = fit.mapInArrow(products, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    v = np.zeros((d, d))
    for r in rows:
        v[r.i, r.j] = r.v / n
    return (v + v.T) / 2


def _project(model: Model, d: int, exact: bool):
    """Whitened entries (and deviations) for batches of (row, x)."""
    to = (model.vectors / np.sqrt(model.values)[:, None]).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = _centred(_matrix(batch.column(1), d), model.n, model.sums)
            white = (z / model.n).astype(float) @ to
            offsets = np.arange(len(z) + 1, dtype=np.int32) * white.shape[1]
            cols = [batch.column(0), pa.array(_deviation(z) if exact else [0] * len(z), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(cols, names=["row", "deviation", "whitened"])
    return run


def _whitened(rows: DataFrame, model: Model, d: int, exact: bool = True) -> DataFrame:
    out = StructType([rows.schema["row"], StructField("deviation", LongType()),
                      StructField("whitened", ArrayType(DoubleType()))])
    return rows.select("row", "x").mapInArrow(_project(model, d, exact), out)


def identity_error(fit: DataFrame, model: Model, d: int) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the identity."""
    k = len(model.values)
    white = _whitened(fit.select(F.struct(F.lit(0).alias("none")).alias("row"), "x"), model, d, False)
    means = list(white.agg(*[F.avg(F.col("whitened")[i]) for i in range(k)]).first())
    off = [F.col("whitened")[i] - F.lit(m) for i, m in enumerate(means)]
    cells = [(i, j) for i in range(k) for j in range(i + 1)]
    got = white.agg(*[F.avg(off[i] * off[j]) for i, j in cells]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(got, cells))


def whiten(rows: DataFrame, vec: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Model, float]:
    """Whiten all usable vectors; also the model and its identity error.

    The table has a struct ``row`` (all columns of ``rows``), ``deviation``
    (exact, n^2 times the squared distance to the mean) and ``whitened`` (an
    array with an entry for each component), one row for each usable input
    row; repeated rows and equal vectors come out each, but count once in
    the fit.

    - null vectors, and vectors with null, non-finite or too large entries: left out
    - vectors of another length than the commonest (ties: the shorter): left out
    - a column without variance is fine; components without variance are
      left out, so fewer than asked may come (none for a single vector)
    - empty table, or empty vectors: no rows
    - a deviation past 64 bits is null
    """
    spark = rows.sparkSession
    data = rows.select(F.struct(*rows.columns).alias("row"), quantised(F.col(vec)).alias("x")).where("x IS NOT NULL")
    lengths = data.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    d = lengths.d if lengths else 0
    empty = Model(0, [], np.zeros(0), np.zeros((0, d)), 0.0)
    if not d:
        return _whitened(data.where(F.lit(False)), empty, d), empty, 0.0
    data = data.where(F.size("x") == d)
    fit = stored(data.select("x").distinct(), "fit")
    n, sums = _moments(fit, d)
    v = covariance(fit, d, n, sums)
    values, vectors = components_of(spark, v, components)
    model = Model(n, sums, values, vectors, float(np.trace(v)))
    error = identity_error(fit, model, d) if len(values) else 0.0
    return _whitened(data, model, d), model, error
