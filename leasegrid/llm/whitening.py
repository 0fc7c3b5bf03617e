"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance of the distinct integer vectors are
found without the covariance itself: every step is one distributed pass that
multiplies the centred rows with a thin block, X^T (X Q) / n. A three-term
Chebyshev recurrence over such passes damps the spectrum between a lower bound
(from a few Lanczos steps) and the smallest Ritz value of the block; QR and
Rayleigh-Ritz follow, until the residuals certify the wanted pairs. Only the
thin block travels: in with the task, out as one partial sum per task, added in
two levels.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasegrid.llm.integer_vectors import finite_rows, integers, longest
from leasegrid.session import cut_lineage

BLOCK_ROWS = 4096
#: Bytes of distinct vectors that one task multiplies.
TASK_BYTES = 8 * 2**20
#: An eigenpair is certified when its residual is at most so many times the largest eigenvalue.
CERTIFIED = 1e-13
LANCZOS_STEPS, DEGREE, MOST_ROUNDS = 12, 10, 60


@dataclass(frozen=True)
class Whitener:
    """Fit of ``n`` distinct vectors: sums per dimension, unit eigenvectors as columns, eigenvalues, trace, residuals."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residuals: np.ndarray

    @property
    def real(self) -> np.ndarray:
        """Components with a variance that is not rounding noise."""
        return self.values > 1e-12 * max(self.trace, 1e-300)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of integer rows; NaN where the variance is zero."""
        scale = np.sqrt(np.where(self.real, self.values, np.nan))
        return (x - self.sums / max(self.n, 1)) @ self.vectors / scale


def distinct_blocks(rows: DataFrame, width: int) -> DataFrame:
    """The fit list: blocks ``(n, data)`` of up to BLOCK_ROWS distinct integer vectors each.

    Vectors are exchanged as bytes (16 bits a component where all fit, else 32),
    so a vector that repeats leaves each task once.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = integers(batch.column(0), width)
            small = (np.abs(x) < 2**15).all(1) if width else np.ones(len(x), bool)
            narrow, wide = x.astype("<i2"), x.astype("<i4")
            yield pa.RecordBatch.from_arrays([pa.array([(narrow if s else wide)[i].tobytes() for i, s in enumerate(small)], pa.binary())], ["key"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column(0).to_pylist()
            for size, kind in ((2, "<i2"), (4, "<i4")):
                some = [k for k in data if len(k) == size * width]
                for a in range(0, len(some), BLOCK_ROWS):
                    part = some[a:a + BLOCK_ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([len(part)], pa.int32()), pa.array([size], pa.int32()), pa.array([b"".join(part)], pa.binary())],
                        ["n", "size", "data"])

    distinct = rows.select("v").mapInArrow(keys, "key binary").distinct()
    return cut_lineage(distinct.mapInArrow(blocks, "n int, size int, data binary"))


def pass_over(blocks: DataFrame, tasks: int, width: int, make: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...], kind=np.float64) -> np.ndarray:
    """Sum of ``make(integer rows)`` over all blocks, read by at most ``tasks`` tasks.

    Every task sends one partial sum; about the square root of that many tasks
    add them, and the driver adds what those return.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, kind)
        for batch in batches:
            for size, data in zip(batch.column(1).to_pylist(), batch.column(2)):
                total += make(np.frombuffer(data.as_py(), f"<i{size}").reshape(-1, width))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, kind)
        for batch in batches:
            for data in batch.column(0):
                total += np.frombuffer(data.as_py(), kind).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    sums = blocks.coalesce(tasks).mapInArrow(partial, "total binary")
    sums = sums.repartition(math.isqrt(tasks)).mapInArrow(add, "total binary")
    return sum((np.frombuffer(r.total, kind).reshape(shape) for r in sums.collect()), np.zeros(shape, kind))


def lanczos(multiply: Callable[[np.ndarray], np.ndarray], width: int, steps: int, rng: np.random.Generator) -> tuple[float, np.ndarray]:
    """A lower bound of the spectrum and the Ritz vectors, largest value first, of a short Lanczos run."""
    v = rng.standard_normal(width)
    basis, alpha, beta = [v / np.linalg.norm(v)], [], []
    for _ in range(steps):
        w = multiply(basis[-1][:, None])[:, 0]
        alpha.append(basis[-1] @ w)
        for _ in range(2):
            for b in basis:
                w = w - (b @ w) * b
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(map(abs, alpha)) or len(alpha) == steps:
            break
        basis.append(w / beta[-1])
    k = len(alpha)
    t = np.diag(alpha) + np.diag(beta[:k - 1], 1) + np.diag(beta[:k - 1], -1)
    theta, s = np.linalg.eigh(t)
    return max(0.0, float(theta[0]) - beta[-1]), np.stack(basis[:k], 1) @ s[:, ::-1]


def chebyshev(multiply, q: np.ndarray, vq: np.ndarray, low: float, cut: float, top: float, degree: int) -> np.ndarray:
    """Chebyshev polynomial of the covariance, small on [low, cut] and 1 at ``top``, applied to ``q``; ``vq`` is the first product."""
    half, mid = (cut - low) / 2, (cut + low) / 2
    first = half / (top - mid)
    scale, before, now = first, q, (vq - mid * q) * (first / half)
    for _ in range(degree - 1):
        nxt = 1 / (2 / first - scale)
        before, now = now, (multiply(now) - mid * now) * (2 * nxt / half) - before * (scale * nxt)
        scale = nxt
    return now


def fit_whitener(rows: DataFrame, width: int, wanted: int = 4, guard: int = 12, seed: int = 7) -> tuple[Whitener, float]:
    """Leading ``wanted`` eigenpairs of the covariance of the distinct integer vectors, and the identity error.

    ``rows`` has the usable vectors in ``v``. ``guard`` further columns of the
    block separate the wanted pairs from the rest. Rounds end when the residual
    norm of every wanted pair is at most CERTIFIED times the largest eigenvalue,
    or when rounding stops it from falling. Signs: the largest entry is positive.
    """
    blocks = distinct_blocks(rows, width)
    n = blocks.agg(F.sum("n")).first()[0] or 0
    wanted = min(wanted, width)
    if not n:
        return Whitener(0, np.zeros(width, np.int64), np.eye(width, wanted), np.zeros(wanted), 0.0, np.zeros(wanted)), 0.0
    tasks = max(1, math.ceil(n * width * 2 / TASK_BYTES))
    sums = pass_over(blocks, tasks, width, lambda x: x.sum(0, dtype=np.int64), (width,), np.int64)
    mean = sums / n

    def multiply(q: np.ndarray) -> np.ndarray:
        def product(x: np.ndarray) -> np.ndarray:
            c = x - mean
            return c.T @ (c @ q)

        return pass_over(blocks, tasks, width, product, q.shape) / n

    trace = float(pass_over(blocks, tasks, width, lambda x: np.square(x - mean).sum(0), (width,)).sum() / n)
    size, rng = min(width, wanted + guard), np.random.default_rng(seed)
    low, start = 0.0, np.eye(width)
    if size < width:
        low, start = lanczos(multiply, width, min(width, LANCZOS_STEPS), rng)
        start = np.concatenate([start, rng.standard_normal((width, size))], 1)[:, :size]
    q = np.linalg.qr(start)[0]
    vq, worst = multiply(q), math.inf
    for _ in range(MOST_ROUNDS):
        theta, s = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        q, vq = q @ s, vq @ s
        residual = np.linalg.norm(vq - q * theta, axis=0)[:wanted]
        top, before, worst = max(float(theta[0]), 0.0), worst, float(residual.max())
        if size == width or worst <= CERTIFIED * top or (worst <= 100 * CERTIFIED * top and worst > before / 2):
            break
        cut = float(theta[-1])
        if cut - low <= 1e-9 * top:
            low = 0.0
        if cut <= 1e-14 * top or cut >= top:
            filtered = vq
        else:
            reach = math.acosh(max(1 + 1e-9, (2 * top - cut - low) / (cut - low)))
            filtered = chebyshev(multiply, q, vq, low, cut, top, max(2, min(DEGREE, int(28 / reach))))
        q = np.linalg.qr(filtered)[0]
        vq = multiply(q)
    u = q[:, :wanted]
    u = u * np.where(u[np.abs(u).argmax(0), np.arange(wanted)] < 0, -1.0, 1.0)
    fit = Whitener(n, sums, u, np.maximum(theta[:wanted], 0.0), trace, residual)
    real = fit.real

    def square(x: np.ndarray) -> np.ndarray:
        z = fit.project(x)[:, real]
        return z.T @ z

    k = int(real.sum())
    spread = pass_over(blocks, tasks, width, square, (k, k)) / n if k else np.zeros((0, 0))
    return fit, float(np.abs(spread - np.eye(k)).max(initial=0.0))


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Exact sum over dimensions of (n x - S)^2 per row; None beyond a long."""
    reach = n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0))
    if reach * reach * x.shape[1] < 2**63:
        return np.square(n * x - sums).sum(1).tolist()
    about = np.square(n * x.astype(np.float64) - sums).sum(1)
    out: list[int | None] = []
    for row, size in zip(x, about):
        exact = sum((n * a - b) ** 2 for a, b in zip(row.tolist(), sums.tolist())) if size < 2.0**63 * 1.001 else 2**63
        out.append(exact if exact < 2**63 else None)
    return out


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error, residual)`` per usable vector and component.

    Entry c becomes the integer floor(256 c), limited to 2^24 either way. The
    fit covers each distinct integer vector once. Vectors that are null or hold
    null or non-finite entries have no row; shorter vectors than the longest end
    in zeros. Repeated rows and ids each have their rows. A component without
    variance (one distinct vector, fewer independent dimensions) has a NULL
    ``whitened`` and stays out of ``identity_error``; fewer dimensions than
    ``components`` give fewer rows, and an empty table none. ``deviation``
    beyond a long is NULL. Other columns are ignored.
    """
    rows = finite_rows(vectors, id_col, vector_col)
    width = longest(rows)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, residual double"
    if not width:
        return vectors.sparkSession.createDataFrame([], schema)
    fit, error = fit_whitener(rows, width, components)
    k = len(fit.values)
    explained = fit.values / fit.trace if fit.trace > 0 else np.zeros(k)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = integers(batch.column(1), width)
            many = len(x)
            z = fit.project(x).T.reshape(-1)
            deviation = deviations(x, fit.n, fit.sums)
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([batch.column(0)] * k), pa.array(np.repeat(np.arange(1, k + 1), many), pa.int32()),
                pa.array(np.full(k * many, fit.n), pa.int64()), pa.array(deviation * k, pa.int64()),
                pa.array(z, pa.float64(), mask=np.isnan(z)), pa.array(np.repeat(explained, many)),
                pa.array(np.full(k * many, error)), pa.array(np.repeat(fit.residuals, many)),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "residual"])

    return rows.select("vec_id", "v").mapInArrow(project, schema)
