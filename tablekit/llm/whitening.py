"""Embedding whitening by incremental eigendecomposition.

The covariance of the distinct vectors is never formed entry by entry.  Each
partition keeps the eigendecomposition Q diag(d) Q' of the scatter of its
vectors so far; a centred vector z updates it by the rank-one change z z'
(``rank_one``): components of Q'z that are zero and pairs of equal poles are
deflated, the secular equation 1 + sum w_j / (d_j - x) = 0 is solved for all
other eigenvalues at once between its poles, and the eigenvectors come from
weights recomputed out of the found roots, so they stay orthogonal.  Spectra
of partitions are combined in a tree: the eigenpairs of one are applied as
successive rank-one updates to the other.  A distributed Rayleigh-Ritz pass
(Q'VQ summed over all vectors, its small eigenproblem solved on the driver)
then removes what thousands of updates have added in rounding, and a further
pass measures the covariance of the whitened vectors.

Entries c become whole numbers floor(scale * c) + shift, so means are exact:
with S = q * n + r, x - S/n is (x - q) - r/n, and the sum of (n*x - S)^2 is
computed in whole numbers.

The driver holds d sums and two d x d matrices for vectors of d entries,
whatever the number of rows; a task holds one or ``FAN`` such matrices.

Defined results: rows whose vector is null or holds a null, NaN or infinite
entry, or one that is no whole number of 62 bits after scaling, are dropped;
an empty vector has no components, so no rows; vectors of different lengths
are an error; repeated rows and null ids are rows like any others, and copies
count once in the fit; components whose eigenvalue is zero up to rounding
cannot be whitened and do not appear (a single distinct vector has none);
``deviation`` is null where it exceeds a long; extra columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.llm.common import col
from tablekit.session import discard, materialize

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
ROWS_PER_TASK = 2_048   # vectors a task folds into one spectrum
FAN = 8                 # spectra a task combines
EPS = np.finfo(np.float64).eps


# ---------------------------------------------------------------- rank-one updates

def _deflate(d: np.ndarray, u: np.ndarray, basis: np.ndarray, rho: float) -> np.ndarray:
    """Rotate pairs of (nearly) equal poles so that one of each has no weight;
    which entries keep weight.  ``d`` (ascending), ``u`` and ``basis`` change in place."""
    tol = 8 * EPS * max(np.abs(d).max(), rho)
    keep = rho * np.abs(u) > tol
    at = np.flatnonzero(keep)
    a, b = at[:-1], at[1:]
    r2 = u[a] ** 2 + u[b] ** 2
    if not ((d[b] - d[a]) * np.abs(u[a] * u[b]) <= tol * r2).any():
        return keep
    last = None
    for j in at:
        if last is not None:
            r = np.hypot(u[last], u[j])
            c, s = u[j] / r, u[last] / r
            if (d[j] - d[last]) * abs(c * s) <= tol:
                old, new = basis[:, last].copy(), basis[:, j].copy()
                basis[:, last], basis[:, j] = c * old - s * new, s * old + c * new
                d[last], d[j] = d[last] * c * c + d[j] * s * s, d[last] * s * s + d[j] * c * c
                u[last], u[j] = 0.0, r
                keep[last] = False
        last = j
    return keep


def secular_roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum w_j / (d_j - x) for ascending poles and positive
    weights: (roots, d_j - root_i as a matrix, accurate near the poles).
    All roots advance together, each kept in its bracket."""
    n = len(d)
    top = d[-1] + w.sum()
    right = np.r_[d[1:], top]
    mid = (d + right) / 2
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        at_mid = 1 + (w / (d - mid[:, None])).sum(axis=1)
        near_left = at_mid >= 0
        near_left[-1] = True
        origin = np.where(near_left, d, right)
        poles = d - origin[:, None]
        half = (right - d) / 2
        low = np.where(near_left, 0.0, -half)
        high = np.where(near_left, half, 0.0)
        if at_mid[-1] < 0:
            low[-1], high[-1] = half[-1], 2 * half[-1]
        x = (low + high) / 2
        left_pole, right_pole = d - origin, right - origin
        lower = np.tri(n, dtype=bool)
        last = np.arange(n) == n - 1
        for step in range(80):
            gap = poles - x[:, None]
            t = w / gap
            f = 1 + t.sum(axis=1)
            low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
            done = np.abs(f) <= 4 * EPS * n * (1 + np.abs(t).sum(axis=1))
            done |= high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high))
            if done.all():
                break
            t /= gap
            slope = t.sum(axis=1)
            below = np.where(lower, t, 0.0).sum(axis=1)
            a0, b0 = left_pole - x, right_pole - x
            c = f - a0 * below - b0 * (slope - below)
            a = (a0 + b0) * f - a0 * b0 * slope
            b = a0 * b0 * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            move = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            move = np.where(last, a0 + a0 * a0 * below / (f - a0 * below), move)
            new = x + move
            new = np.where((new > low) & (new < high), new, (low + high) / 2)
            x = np.where(done, x, new)
    gap = poles - x[:, None]
    gap[gap == 0] = np.finfo(np.float64).tiny
    return origin + x, gap


def rank_one(d: np.ndarray, basis: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of basis diag(d) basis' + z z'."""
    u = basis.T @ z
    rho = float(u @ u)
    if rho == 0 or not np.isfinite(rho):
        return d, basis
    d, basis, u = d.copy(), basis.copy(), u / np.sqrt(rho)
    keep = _deflate(d, u, basis, rho)
    at = np.flatnonzero(keep)
    at = at[np.argsort(d[at], kind="stable")]
    if len(at):
        poles, v = d[at], u[at]
        roots, gap = secular_roots(poles, rho * v * v)
        apart = poles[:, None] - poles                       # d_i - d_j
        np.fill_diagonal(apart, 1.0)
        weight = np.sqrt(np.abs((-gap / apart).prod(axis=0)))  # of the system whose roots these are exactly
        vectors = (np.copysign(weight, v) / gap).T
        vectors /= np.sqrt((vectors * vectors).sum(axis=0))
        basis[:, at] = basis[:, at] @ vectors
        d[at] = roots
    order = np.argsort(d, kind="stable")
    return d[order], basis[:, order]


def combine(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum of the sum of two scatters: the pairs of ``other`` as rank-one updates of ``one``."""
    d, basis = one
    for value, vector in zip(other[0], other[1].T):
        if value > 0:
            d, basis = rank_one(d, basis, np.sqrt(value) * vector)
    return d, basis


# ---------------------------------------------------------------- over partitions

_PART = T.StructType([T.StructField("part", T.LongType()), T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])


def _matrix(batch: pa.RecordBatch | pa.Array, d: int) -> np.ndarray:
    return batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _tree(parts: DataFrame, merge: Callable, name: str) -> tuple[bytes, bytes]:
    """Merge one row a partition, ``FAN`` at a time, until one is left."""
    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        a, b = rows["a"].iloc[0], rows["b"].iloc[0]
        for x, y in zip(rows["a"].iloc[1:], rows["b"].iloc[1:]):
            a, b = merge((a, b), (x, y))
        return pd.DataFrame({"part": [int(rows["part"].iloc[0]) // FAN], "a": [a], "b": [b]})

    held = materialize(parts, name)
    while held.agg(F.count(F.lit(1))).first()[0] > 1:
        step = materialize(held.groupBy(F.floor(F.col("part") / FAN).alias("g")).applyInPandas(fold, _PART), name)
        discard(held)
        held = step
    row = held.first()
    discard(held)
    return bytes(row["a"]), bytes(row["b"])


def _centre(x: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    return (x - q) - r


def _spectrum(vectors: DataFrame, d: int, q: np.ndarray, r: np.ndarray, parts: int) -> np.ndarray:
    """A first eigenbasis of the scatter, d x d, by rank-one updates."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        values, basis = np.zeros(d), np.eye(d)
        n = 0
        for batch in batches:
            for z in _centre(_matrix(batch.column(0), d), q, r):
                values, basis = rank_one(values, basis, z)
            n += batch.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              pa.array([values.tobytes()], pa.binary()),
                                              pa.array([basis.tobytes()], pa.binary())], names=_PART.names)

    def merge(one, other):
        (v, b) = combine(*[(np.frombuffer(v), np.frombuffer(b).reshape(d, d)) for v, b in (one, other)])
        return v.tobytes(), b.tobytes()

    # a task's work is in its vectors' count, which byte sizes do not tell
    spread = vectors.repartition(parts, F.xxhash64("x"))
    return np.frombuffer(_tree(spread.mapInArrow(fold, _PART), merge, "spectra")[1]).reshape(d, d)


def _rotated(vectors: DataFrame, d: int, q: np.ndarray, r: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """basis' V basis * n, summed over all vectors."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((d, d))
        for batch in batches:
            y = _centre(_matrix(batch.column(0), d), q, r) @ basis
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                          pa.array([total.tobytes()], pa.binary()), pa.array([b""], pa.binary())],
                                         names=_PART.names)

    def merge(one, other):
        return (np.frombuffer(one[0]) + np.frombuffer(other[0])).tobytes(), b""

    return np.frombuffer(_tree(vectors.mapInArrow(fold, _PART), merge, "ritz")[0]).reshape(d, d)


def refine(vectors: DataFrame, n: int, d: int, q: np.ndarray, r: np.ndarray, basis: np.ndarray,
           error: float = 1e-10, rounds: int = 4) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """Rayleigh-Ritz rounds: eigenvalues (falling), eigenvectors, trace, and
    the covariance of the vectors in that basis as measured."""
    ritz = _rotated(vectors, d, q, r, basis) / n
    for _ in range(rounds):
        values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
        basis = np.linalg.qr(basis @ turn[:, ::-1])[0]
        ritz = _rotated(vectors, d, q, r, basis) / n
        values = np.diag(ritz)
        some = values > d * EPS * values.max()
        scale = np.sqrt(values[some])
        if not some.any() or np.abs(ritz[np.ix_(some, some)] / np.outer(scale, scale) - np.eye(some.sum())).max() <= error:
            break
    order = np.argsort(-np.diag(ritz), kind="stable")
    return np.diag(ritz)[order], basis[:, order], float(np.trace(ritz)), ritz[np.ix_(order, order)]


def whiten(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, shift: int = SHIFT, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One row per usable row and component: vec_id, component, n, deviation,
    whitened, explained, identity_error."""
    entry = lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))
    # NaN compares above every number, so it fails too
    usable = F.coalesce(F.forall(col(vector), lambda c: c.isNotNull() & (F.abs(F.lit(float(scale)) * c.cast("double")) < float(1 << 61))),
                        F.lit(False))
    rows = embeddings.select(col(vec_id).alias("vec_id"), F.when(
        usable, F.transform(col(vector), lambda c: entry(c).cast("long") + F.lit(shift))).alias("x")).where("size(x) > 0")
    schema = T.StructType([
        T.StructField("vec_id", rows.schema["vec_id"].dataType), T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    spark = embeddings.sparkSession
    vectors = materialize(rows.select("x").distinct(), "vectors")
    n, short, d = vectors.agg(F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x"))).first()
    if not n:
        return spark.createDataFrame([], schema)
    if short != d:
        raise ValueError(f"vectors of {short} and of {d} entries")
    sums = (vectors.select(F.posexplode("x")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(19,0)")).alias("s")))
    total = [int(s["s"]) for s in sorted(sums.collect(), key=lambda s: s["pos"])]
    whole = [s // n for s in total]
    q, r = np.array(whole, dtype=np.int64), np.array([(s - w * n) / n for s, w in zip(total, whole)])
    left = [s - w * n for s, w in zip(total, whole)]
    basis = _spectrum(vectors, d, q, r, max(1, -(-n // rows_per_task)))
    values, basis, trace, ritz = refine(vectors, n, d, q, r, basis)
    keep = int(((values > d * EPS * values[0]) & (values > 0))[:components].sum())
    if not keep:
        return spark.createDataFrame([], schema)
    values, top = values[:keep], np.ascontiguousarray(basis[:, :keep])
    whitener = top / np.sqrt(values)
    error = float(np.abs(ritz[:keep, :keep] / np.sqrt(np.outer(values, values)) - np.eye(keep)).max())
    explained = values / trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                x = _matrix(part.column(1), d) - q
                k = len(x)
                reach = n * (int(np.abs(x).max()) + 1)
                if d * reach * reach < 1 << 62:
                    deviation = ((n * x - np.array(left)) ** 2).sum(axis=1).tolist()
                else:
                    deviation = [sum((n * int(c) - s) ** 2 for c, s in zip(row, left)) for row in x]
                    deviation = [v if v < 1 << 63 else None for v in deviation]
                white = (x - r) @ whitener
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(np.arange(k), keep))),
                    pa.array(np.tile(np.arange(1, keep + 1, dtype=np.int32), k)), pa.array(np.full(k * keep, n, dtype=np.int64)),
                    pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(k), keep))), pa.array(white.ravel()),
                    pa.array(np.tile(explained, k)), pa.array(np.full(k * keep, error))], names=schema.names)

    return rows.mapInArrow(project, schema)
