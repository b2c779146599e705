"""PCA whitening of vectors by a block Jacobi-Davidson method.

The covariance V is never formed. Vectors become whole numbers x, their sums S
are exact, and a product V*Q of a few columns is one Spark job: each task sums
the centred rows times their own products with Q, and the tasks' sums, a few
hundred numbers each, are added, in tasks too where they are many. The driver holds the search space (dimension x a few dozen
numbers), never rows.

For the wanted Ritz pairs together, an outer step solves the correction
equations (I - QQ')(V - theta)(I - QQ') t = -r by MINRES, all columns in step,
so that an inner step too is one job; Q holds the locked and the wanted Ritz
vectors. The corrections extend the search space, Rayleigh-Ritz gives new
pairs, and a pair is locked when its residual is at rounding level.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored

SCALE, SHIFT = 1024, 100_000
#: Residual, as a share of the largest eigenvalue, at which a pair is locked.
TOLERANCE = 1e-14
#: Inner MINRES steps of an outer step, and columns of the search space before it is restarted.
INNER, SPACE = 6, 96
MAX_OUTER = 200


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                  scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``(vec_id, x)`` with x = floor(scale * entry) + shift, of the rows with usable vectors.

    Vectors that are null or empty, or hold null or non-finite entries, are not
    usable. Neither are those with entries of 2**52 / scale or more, whose x is
    not exact in double precision, nor vectors of another length than the
    commonest (the longer one of a tie).
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(f"size(vector) > 0 and forall(vector, c -> c is not null and not isnan(c) and abs(c) < {2 ** 52 / scale})")
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = rows.where(F.size("vector") == (common.n if common else 0))
    return rows.select("vec_id", F.transform("vector", lambda c: F.floor(c * scale).cast("long") + shift).alias("x"))


def _matrix(column) -> np.ndarray:
    """The rows of a column of lists of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


#: Partial sums that the driver adds itself; more are added in tasks first, about the square root of their number in each.
DIRECT = 64


def _sum_of(rows: DataFrame, tasks: int, work, shape: tuple) -> np.ndarray:
    """The sum over all Arrow batches of ``work(batch)``, an array of ``shape``; ``tasks`` is the number of partitions of ``rows``."""
    size = int(np.prod(shape))

    def added(batches, of):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += of(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["part"])

    parts = rows.mapInArrow(lambda batches: added(batches, lambda b: work(b).ravel()), "part array<double>")
    if tasks > DIRECT:
        parts = (parts.repartition(math.isqrt(tasks))
                 .mapInArrow(lambda batches: added(batches, lambda b: _matrix(b.column(0)).sum(axis=0)), "part array<double>"))
    return np.sum([r.part for r in parts.collect()], axis=0).reshape(shape)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n, rounded once: n*x - S is exact, in Python's integers where 64 bits do not hold it."""
    if n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, sums)) < 2 ** 62:
        return (n * x - np.array(sums, np.int64)) / n
    return ((n * x.astype(object) - np.array(sums, object)) / n).astype(float)


class Covariance:
    """Products with the covariance of a table of vectors."""

    def __init__(self, rows: DataFrame, n: int, sums: list[int]):
        self.rows, self.n, self.sums, self.products = rows.select("x"), n, sums, 0
        self.tasks = self.rows.rdd.getNumPartitions()
        self.dim = len(sums)

    def __matmul__(self, q: np.ndarray) -> np.ndarray:
        n, sums = self.n, self.sums

        def work(batch):
            x = centred(_matrix(batch.column(0)), n, sums)
            return x.T @ (x @ q)

        self.products += 1
        return self.sum_of(work, q.shape) / n

    def sum_of(self, work, shape: tuple) -> np.ndarray:
        return _sum_of(self.rows, self.tasks, work, shape)

    def trace(self) -> float:
        n, sums = self.n, self.sums
        return float(self.sum_of(lambda b: np.array([(centred(_matrix(b.column(0)), n, sums) ** 2).sum()]), (1,))[0]) / n


def orthonormal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Directions of ``new`` outside ``basis``, with unit length; those that hold rounding only are left out."""
    out = basis
    for v in new.T:
        size = np.linalg.norm(v)
        if not size:
            continue
        v = v / size
        for _ in range(3):
            v = v - out @ (out.T @ v)
        left = np.linalg.norm(v)
        if left < 1e-10:
            continue
        v = v / left
        v = v - out @ (out.T @ v)
        out = np.column_stack([out, v / np.linalg.norm(v)])
    return out[:, basis.shape[1]:]


def minres(product, theta: np.ndarray, q: np.ndarray, b: np.ndarray, steps: int) -> np.ndarray:
    """MINRES for (I - qq')(V - theta_j)(I - qq') t_j = b_j, all columns j in step; one product a step."""
    def project(v):
        return v - q @ (q.T @ v)

    b = project(b)
    t = np.zeros_like(b)
    beta = np.linalg.norm(b, axis=0)
    old_v, v = np.zeros_like(b), b / np.where(beta > 0, beta, 1)
    w1 = w2 = np.zeros_like(b)
    eta, beta_k = beta.copy(), beta
    c1 = c2 = np.ones_like(beta)
    s1 = s2 = np.zeros_like(beta)
    on = beta > 0
    for k in range(steps):
        if not on.any():
            break
        av = project(product @ v - theta * v)
        alpha = (v * av).sum(axis=0)
        new = project(av - alpha * v - (beta_k if k else 0) * old_v)
        beta_next = np.linalg.norm(new, axis=0)
        # Givens rotations of the tridiagonal matrix
        d1 = c1 * alpha - (c2 * s1 * beta_k if k else 0)
        r1 = np.hypot(d1, beta_next)
        r2 = s1 * alpha + (c2 * c1 * beta_k if k else 0)
        r3 = s2 * beta_k if k else np.zeros_like(beta)
        ok = on & (r1 > 0)
        safe = np.where(ok, r1, 1)
        c, s = d1 / safe, beta_next / safe
        w = (v - r3 * w2 - r2 * w1) / safe
        t = np.where(ok, t + c * eta * w, t)
        eta = np.where(ok, -s * eta, eta)
        on = ok & (beta_next > 1e-14 * np.maximum(np.abs(theta), 1e-300))
        old_v, v = v, np.where(on, new / np.where(on, beta_next, 1), 0)
        w2, w1, c2, c1, s2, s1, beta_k = w1, w, c1, c, s1, s, beta_next
    return project(t)


def leading(v: Covariance, k: int, inner: int = INNER, space: int = SPACE, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of ``v``, falling, with unit eigenvectors in columns."""
    d = v.dim
    k = min(k, d)
    space = min(max(space, 3 * k), d)
    basis = orthonormal(np.random.default_rng([seed, d]).standard_normal((d, min(k + 2, d))), np.zeros((d, 0)))
    image = v @ basis
    best, stuck = np.inf, 0
    for _ in range(MAX_OUTER):
        small = basis.T @ image
        theta, y = np.linalg.eigh((small + small.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        ritz, own = basis @ y[:, :k], image @ y[:, :k]
        residual = own - ritz * theta[:k]
        size = np.linalg.norm(residual, axis=0) / max(theta[0], np.finfo(float).tiny)
        open_ = np.flatnonzero(size > TOLERANCE)
        stuck = stuck + 1 if size.max() > best / 2 else 0
        best = min(best, size.max())
        # the products' own rounding bounds the residual: no half of it for some steps means that it is reached
        if not len(open_) or (stuck >= 3 and best < 1e-11):
            break
        if basis.shape[1] + len(open_) > space and basis.shape[1] > 2 * k and basis.shape[1] < d:
            basis, image = basis @ y[:, :2 * k], image @ y[:, :2 * k]  # restart with the leading Ritz vectors
        if basis.shape[1] < d:
            # pairs below the tolerance are locked: they stay in the projector and get no correction
            t = minres(v, theta[open_], ritz, -residual[:, open_], inner)
            new = orthonormal(np.column_stack([t, residual[:, open_]])[:, :max(2 * len(open_), 1)], basis)[:, :len(open_)]
        else:
            new = np.zeros((d, 0))
        if not new.shape[1]:
            # the space is complete: take its vectors' images afresh once, orthonormal to rounding
            basis = np.linalg.qr(basis @ y)[0]
            image = v @ basis
            continue
        basis, image = np.column_stack([basis, new]), np.column_stack([image, v @ new])
    return theta[:k], ritz / np.linalg.norm(ritz, axis=0)


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for each usable row and component.

    See ``whole_vectors`` for the rows that are usable; repeated rows count as
    often as they occur. Components are at most ``components`` and at most the
    dimension. Where a component's eigenvalue is zero to rounding (as when
    there are no more rows than components) ``whitened`` is null, and
    ``identity_error`` is taken over the others (null if there are none).
    ``deviation`` is null when it does not fit in a long. Without usable rows
    the result is empty. Other columns are not read.
    """
    rows = stored(whole_vectors(vectors, id_col, vector_col), "whole-vectors")
    first = rows.select(F.size("x").alias("d")).first()
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if first is None:
        return rows.sparkSession.createDataFrame([], schema)
    stats = rows.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n"))
    stats = sorted(stats.collect())
    n, sums = stats[0].n, [int(r.s) for r in stats]
    v = Covariance(rows, n, sums)
    trace = v.trace()
    values, q = leading(v, components)
    k = len(values)
    # rounding of a zero eigenvalue is a small multiple of the trace
    real = values > 1e-13 * max(trace, 0)
    scale = np.where(real, 1 / np.sqrt(np.where(real, values, 1)), 0)

    def white(batch):
        return centred(_matrix(batch.column(0)), n, sums) @ q * scale

    mean = v.sum_of(lambda b: white(b).sum(axis=0), (k,)) / n
    gram = v.sum_of(lambda b: (white(b) - mean).T @ (white(b) - mean), (k, k)) / n
    error = np.abs(gram - np.eye(k))[np.ix_(real, real)].max(initial=0.0) if real.any() else None
    explained = values / trace if trace > 0 else np.zeros(k)

    def out(batches):
        for batch in batches:
            x = _matrix(batch.column(1)).astype(np.int64)
            w = centred(x, n, sums) @ q * scale
            off = n * x.astype(object) - np.array(sums, object)
            if n * int(np.abs(x).max(initial=0)) + max(map(abs, sums)) < 2 ** 62:
                off = n * x - np.array(sums, np.int64)
                if len(sums) * int(np.abs(off).max(initial=0)) ** 2 >= 2 ** 63:
                    off = off.astype(object)
            deviation = [None if s >= 2 ** 63 else int(s) for s in (off * off).sum(axis=1).tolist()]
            m = batch.num_rows
            repeat = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(repeat), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n)), pa.array(deviation, pa.int64()).take(repeat),
                pa.array(w.ravel(), mask=np.tile(~real, m)), pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error if error is not None else 0.0), mask=np.full(m * k, error is None))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(out, schema)
