"""Whitening of embeddings by the leading eigenvectors of their covariance, found by a block Jacobi-Davidson method."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from care_measures.llm import common
from care_measures.llm.common import stored

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
#: Steps of MINRES for a correction equation; Ritz vectors beyond the wanted ones; partial sums that reach the driver.
INNER, GUARD, PARTIALS = 4, 8, 16
_EPS = float(np.finfo(np.float64).eps)


def fit_list(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): the vectors that are whole, entries c as integers floor(64 c) + 1000000, stored.

    A null vector goes, and one with a null, infinite or NaN entry. What is left should be of one length; vectors of another
    than the commonest (of equally common ones, the longest) or of none have no place in that space and go too."""
    spark = embeddings.sparkSession
    common._ship(spark.sparkContext.applicationId)
    c = F.col(vector).cast("array<double>")
    whole = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), c.alias("c")).filter(c.isNotNull() & whole & (F.size(c) > 0))
    lengths = rows.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    x = F.transform("c", lambda v: F.floor(v * SCALE).cast("long") + OFFSET)
    return stored(rows.filter(F.size("c") == d).select("vec_id", x.alias("x")), "vectors")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _total(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum of part(x) over blocks of rows x, as one flat array: added up in each task, then in a few tasks, then here, so
    the driver gets PARTIALS arrays at most."""
    numpy_kind = np.int64 if kind == "long" else np.float64

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                more = part(_matrix(batch["x"]))
                total = more if total is None else total + more
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": [total.astype(numpy_kind).tobytes()]})

    def of_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for one in batch["part"].to_pylist():
                one = np.frombuffer(one, numpy_kind)
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": [total.tobytes()]})

    parts = rows.select("x").mapInArrow(in_task, "part binary").repartition(PARTIALS).mapInArrow(of_tasks, "part binary").collect()
    return sum((np.frombuffer(p["part"], numpy_kind) for p in parts), np.zeros(1, numpy_kind))


def _minres(product: Callable, shifts: np.ndarray, against: np.ndarray, right: np.ndarray, steps: int) -> np.ndarray:
    """Solves P (A - shift) P t = right for every column, P projecting `against` away: all columns advance together, so that a
    step is one product. A column ends early, by itself, when its Krylov space does."""
    project = lambda m: m - against @ (against.T @ m)
    norm = lambda m: np.sqrt((m * m).sum(axis=0))
    over = lambda a, b: np.divide(a, b, out=np.zeros_like(a), where=np.abs(b) > 0)
    v_old, v = np.zeros_like(right), project(right)
    beta = start = norm(v)
    v = over(v, np.broadcast_to(beta, v.shape))
    w_old, w, t = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    c, c_old = np.ones_like(beta), np.ones_like(beta)
    s, s_old = np.zeros_like(beta), np.zeros_like(beta)
    eta, beta = start.copy(), np.zeros_like(start)
    for _ in range(steps):
        y = project(product(v) - v * shifts)
        alpha = (v * y).sum(axis=0)
        y -= v * alpha + v_old * beta
        y = project(y)
        beta_new = norm(y)
        beta_new[beta_new <= 16 * _EPS * (np.abs(alpha) + beta + np.abs(shifts))] = 0
        r1 = c * alpha - c_old * s * beta
        r2 = s * alpha + c_old * c * beta
        r3 = s_old * beta
        r = np.hypot(r1, beta_new)
        c_old, s_old = c, s
        c, s = over(r1, r), over(beta_new, r)
        w_old, w = w, over(v - w_old * r3 - w * r2, np.broadcast_to(r, v.shape))
        t += w * (c * eta)
        eta = -s * eta
        v_old, v = v, over(y, np.broadcast_to(beta_new, y.shape))
        beta = beta_new
    return t


def _orthonormal(m: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what m adds to `against`."""
    size = np.sqrt((m * m).sum(axis=0))
    m = m[:, size > 0] / size[size > 0]
    for _ in range(3):
        m = m - against @ (against.T @ m)
        u, sizes, _ = np.linalg.svd(m, full_matrices=False)
        m = u[:, sizes > 1e-8 * max(1.0, sizes.max(initial=0))]
    return m


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, inner: int = INNER, rounds: int = 200,
                    seed: int = 20240601) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues of a symmetric d x d matrix, falling, their unit eigenvectors and residual norms over
    the largest eigenvalue. The matrix is known by `product`, its product with a block of columns, alone.

    In each round Rayleigh-Ritz gives the best pairs of the subspace; leading pairs whose residual is a rounding error are
    locked; for the others correction equations, projected against locked and current vectors, are solved by `inner` steps
    of MINRES and widen the subspace. It is cut to its best Ritz vectors when it has three times the wanted columns. A
    residual that no longer shrinks, at 1e-11 of the largest value or less, has reached what sums over all rows allow."""
    wanted = min(wanted, d)
    width = min(d, wanted + GUARD)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0]
    images = product(basis)
    locked, values = np.zeros((d, 0)), np.zeros(0)
    least, stalled = np.inf, 0
    for _ in range(rounds):
        square = basis.T @ images
        theta, s = np.linalg.eigh((square + square.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        basis, images = basis @ s, images @ s
        residual = images - basis * theta
        residual -= locked @ (locked.T @ residual)
        size = np.sqrt((residual * residual).sum(axis=0))
        largest = max(float(theta[0]), float(values.max(initial=0)), 0.0)
        left = wanted - len(values)
        worst = size[:left].max()
        stalled = 0 if worst < least / 2 else stalled + 1
        least = min(least, worst)
        done = size <= 8 * _EPS * np.sqrt(d) * largest
        if stalled >= 3:
            done |= size <= 1e-11 * largest
        if locked.shape[1] + basis.shape[1] >= d:
            done[:] = True  # the subspace is the whole space
        n = int(np.argmin(done)) if not done.all() else len(done)
        n = min(n, left)
        if n:
            locked, values = np.hstack([locked, basis[:, :n]]), np.concatenate([values, theta[:n]])
            basis, images, theta, residual = basis[:, n:], images[:, n:], theta[n:], residual[:, n:]
            least, stalled = np.inf, 0
        if len(values) >= wanted:
            break
        if basis.shape[1] > 3 * width:
            basis, images = basis[:, :width], images[:, :width]
        t = min(wanted - len(values) + GUARD, basis.shape[1])
        fixed = np.hstack([locked, basis[:, :t]])
        steps = _minres(product, theta[:t], fixed, -residual[:, :t], inner)
        more = _orthonormal(steps, np.hstack([locked, basis]))
        if not more.shape[1]:
            more = _orthonormal(np.random.default_rng(seed + 1).standard_normal((d, min(t, d - locked.shape[1] - basis.shape[1]))),
                                np.hstack([locked, basis]))
        basis, images = np.hstack([basis, more]), np.hstack([images, product(more)])
    else:
        raise RuntimeError(f"{wanted - len(values)} eigenvectors have not converged in {rounds} rounds")
    # The locked pairs together, by a product of their own.
    locked = np.linalg.qr(locked)[0]
    images = product(locked)
    square = locked.T @ images
    theta, s = np.linalg.eigh((square + square.T) / 2)
    theta, vectors, images = theta[::-1], locked @ s[:, ::-1], images @ s[:, ::-1]
    size = np.sqrt(((images - vectors * theta) ** 2).sum(axis=0))
    return theta, vectors, size / max(float(theta[0]) if len(theta) else 0.0, np.finfo(float).tiny)


@dataclass(frozen=True)
class Whitening:
    """n vectors, sums S of their entries, eigenvalues, eigenvectors, residuals, the trace of the covariance, and the largest
    entry of the whitened vectors' covariance less the identity."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    trace: float
    identity_error: float


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x less the mean: n x - S is exact, so nothing is lost to the offset."""
    return (n * x - sums) / n


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the rows of `fit_list`; None if there are none. Every product with the covariance is one pass over
    the centred rows, in tasks that hold a block of rows and a block of columns; the covariance is never formed.

    Components whose eigenvalue is zero but for rounding cannot be whitened and are left out, so there may be fewer."""
    def counted(x):
        return np.concatenate([[len(x)], x.sum(axis=0)])

    first = _total(vectors, counted, "long")
    n, sums = int(first[0]), first[1:]
    if not n:
        return None

    def product(block: np.ndarray) -> np.ndarray:
        def part(x):
            c = _centred(x, n, sums)
            return (c.T @ (c @ block)).ravel()

        return _total(vectors, part).reshape(block.shape) / n

    trace = float(_total(vectors, lambda x: (_centred(x, n, sums) ** 2).sum(keepdims=True).ravel())[0]) / n
    if trace == 0:
        return Whitening(n, sums, np.zeros(0), np.zeros((len(sums), 0)), np.zeros(0), trace, 0.0)
    values, found, residuals = jacobi_davidson(product, len(sums), components)
    known = values > len(sums) * 8 * _EPS * values[0]
    values, found, residuals = values[known], found[:, known], residuals[known]
    weights = found / np.sqrt(values)

    def moments(x):
        w = _centred(x, n, sums) @ weights
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    sums_of = _total(vectors, moments) / n
    k = len(values)
    covariance = sums_of[k:].reshape(k, k) - np.outer(sums_of[:k], sums_of[:k])
    return Whitening(n, sums, values, found, residuals, trace, float(np.abs(covariance - np.eye(k)).max()))


_OUT = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()),
                  ("explained", pa.float64()), ("identity_error", pa.float64()), ("residual", pa.float64())])
_DDL = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, residual double"


def whiten(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """A row for each row of `fit_list` and component: vec_id, component, n, deviation, whitened, explained, identity_error,
    residual (that component's, over the largest eigenvalue).

    Repeated rows and null ids each have rows of their own. A deviation that does not fit a long is null. Without vectors,
    and where all are equal, there is no component and no row."""
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], _DDL)
    n, sums, k = model.n, model.sums, len(model.values)
    weights = model.vectors / np.sqrt(model.values)
    each = [model.values / model.trace, np.full(k, model.identity_error), model.residuals]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                block = batch.slice(at, 2000)
                x = _matrix(block["x"])
                off, rows = n * x - sums, len(x)
                fits = (off.astype(np.float64) ** 2).sum(axis=1) < 9.2e18
                deviation = pa.array(np.repeat((off * off).sum(axis=1), k), mask=np.repeat(~fits, k))
                yield pa.RecordBatch.from_arrays([
                    block["vec_id"].take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, np.int64)), deviation, pa.array((off / n @ weights).ravel()),
                    *[pa.array(np.tile(e, rows)) for e in each]], schema=_OUT)

    return vectors.mapInArrow(run, _DDL)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = fit_list(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return whiten(vectors, fit(vectors))
