"""Least squares and the Lasso from cross products.

Rows are read twice: for the means, and for the products of the centred columns.
Each task adds its rows as one matrix product per batch, about the square root
of the shuffle partitions add the tasks' matrices, and the driver solves on
p x p numbers, so the number of rows and of columns grow apart.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leasegrid.operators.ordering import row_numbers
from leasegrid.operators.profile import _f_tail


def summed(df: DataFrame, columns: Sequence[str], make: Callable[[np.ndarray], np.ndarray], by: str | None = None) -> dict[int, np.ndarray]:
    """Sum over all rows of ``make(matrix of the columns)``, per value of the integer column ``by`` (0 without).

    ``make`` returns arrays of one shape. One partial sum per task and value is
    exchanged, and one per value and adding task reaches the driver.
    """
    key = F.lit(0) if by is None else F.col(by)
    rows = df.select(key.cast("int").alias("__by"), *[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])

    def flush(totals: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array([list(t.shape) for t in totals.values()], pa.list_(pa.int32())), pa.array([t.tobytes() for t in totals.values()], pa.binary())],
            ["by", "shape", "total"],
        )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.column_stack([batch.column(i + 1).to_numpy(zero_copy_only=False) for i in range(len(columns))])
            for k in np.unique(keys):
                part = make(x[keys == k])
                totals[int(k)] = totals[int(k)] + part if int(k) in totals else part
        yield flush(totals)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, shape, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                part = np.frombuffer(data).reshape(shape)
                totals[k] = totals[k] + part if k in totals else part
        yield flush(totals)

    schema = "by int, shape array<int>, total binary"
    adders = max(1, math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    out: dict[int, np.ndarray] = {}
    for r in rows.mapInArrow(partial, schema).repartition(adders).mapInArrow(add, schema).collect():
        part = np.frombuffer(r.total).reshape(r.shape)
        out[r.by] = out[r.by] + part if r.by in out else part
    return out


@dataclass(frozen=True)
class Products:
    """Number of rows, and the weighted products of (1, columns less ``means``) with themselves."""

    n: int
    means: np.ndarray
    g: np.ndarray

    def __add__(self, other: Products) -> Products:
        return Products(self.n + other.n, self.means, self.g + other.g)

    def __sub__(self, other: Products) -> Products:
        return Products(self.n - other.n, self.means, self.g - other.g)

    def centred(self) -> tuple[np.ndarray, np.ndarray]:
        """(offset of the means, covariance) with divisor sum of weights."""
        w = self.g[0, 0]
        offset = self.g[0, 1:] / w
        return offset, self.g[1:, 1:] / w - np.outer(offset, offset)


def cross_products(df: DataFrame, columns: Sequence[str], weight: str | None = None, by: str | None = None) -> dict[int, Products]:
    """Products of the columns about their common weighted means, per value of ``by``. Columns hold no nulls."""
    columns = list(columns)
    read = [*columns, weight] if weight else columns
    p = len(columns)

    def split(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (x[:, :p], x[:, p]) if weight else (x, np.ones(len(x)))

    def totals(x: np.ndarray) -> np.ndarray:
        v, w = split(x)
        return np.concatenate([[w.sum()], w @ v])

    whole = summed(df, read, totals).get(0, np.zeros(p + 1))
    means = whole[1:] / whole[0] if whole[0] else np.zeros(p)

    def products(x: np.ndarray) -> np.ndarray:
        v, w = split(x)
        z = np.column_stack([np.ones(len(v)), v - means])
        out = np.zeros((p + 2, p + 1))
        out[:-1] = z.T @ (z * w[:, None])
        out[-1, 0] = len(v)
        return out

    return {k: Products(int(m[-1, 0]), means, m[:-1]) for k, m in summed(df, read, products, by).items()}


def pivoted_factor(a: np.ndarray, tol: float = 1e-10) -> np.ndarray:
    """Factor L with a = L L^T of a symmetric positive semidefinite matrix, one column per independent column of ``a``.

    Each step takes the column with the largest rest on the diagonal and stops
    when that is at most ``tol`` times the largest at the start.
    """
    rest, columns = np.diag(a).astype(float).copy(), []
    limit = tol * max(rest.max(initial=0.0), 0.0)
    for _ in range(len(a)):
        j = int(rest.argmax())
        if rest[j] <= limit:
            break
        column = a[:, j].astype(float)
        for c in columns:
            column = column - c * c[j]
        column = column / math.sqrt(max(column[j], 1e-300))
        columns.append(column)
        rest = np.maximum(rest - column**2, 0.0)
        rest[j] = 0.0
    return np.stack(columns, 1) if columns else np.zeros((len(a), 0))


def pseudo_inverse(a: np.ndarray) -> tuple[np.ndarray, int]:
    """Pseudo-inverse and rank by the pivoted factor: L (L^T L)^-2 L^T."""
    f = pivoted_factor(a)
    inner = np.linalg.inv(f.T @ f) if f.shape[1] else np.zeros((0, 0))
    half = f @ inner
    return half @ half.T, f.shape[1]


@dataclass(frozen=True)
class LinearFit:
    """Coefficients (intercept first), their errors and the training R2."""

    names: tuple[str, ...]
    coefficients: tuple[float, ...]
    errors: tuple[float, ...]
    p_values: tuple[float, ...]
    r2: float
    n: int
    rank: int

    def as_dict(self) -> dict[str, float]:
        return dict(zip(self.names, self.coefficients))

    def predict(self) -> Column:
        out = F.lit(self.coefficients[0])
        for name, b in zip(self.names[1:], self.coefficients[1:]):
            out = out + F.lit(float(b)) * F.col(f"`{name}`")
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [tuple(r) for r in zip(self.names, self.coefficients, self.errors, self.p_values)]
        schema = "feature string, coefficient double, std_error double, p_value double"
        return spark.createDataFrame([(n, float(c), float(e), float(p)) for n, c, e, p in rows], schema)


def least_squares(df: DataFrame, features: Sequence[str], label: str, weight: str | None = None) -> LinearFit:
    """OLS, or WLS with ``weight``, with standard errors and p-values.

    Rows with a missing value are left out. Collinear columns (full dummy sets
    beside an intercept) get the solution of least norm in standardised columns.
    """
    columns = [*features, label]
    clean = df.select(*dict.fromkeys([*columns, *([weight] if weight else [])])).na.drop()
    found = cross_products(clean, columns, weight)
    if 0 not in found:
        raise ValueError("no row without missing values")
    fit = found[0]
    p, w = len(features), fit.g[0, 0]
    scales = np.sqrt(np.maximum(np.diag(fit.g)[1:] / w, 0))
    scales = np.where(scales > 0, scales, 1.0)
    unit = np.concatenate([[1.0], scales])
    g = fit.g / np.outer(unit, unit)
    xx, xy, yy = g[: p + 1, : p + 1], g[: p + 1, p + 1], g[p + 1, p + 1]
    inv, rank = pseudo_inverse(xx / w)
    inv = inv / w
    beta = inv @ xy
    beta = beta + inv @ (xy - xx @ beta)
    sse = max(float(yy - 2 * beta @ xy + beta @ xx @ beta), 0.0)
    dof = fit.n - rank
    cov = inv * (sse / dof if dof > 0 else np.nan)
    # back to the original scale
    sx, sy, mx, my = scales[:p], scales[p], fit.means[:p], fit.means[p]
    back = np.zeros((p + 1, p + 1))
    back[0, 0] = sy
    back[0, 1:] = -mx * sy / sx
    back[1:, 1:] = np.diag(sy / sx)
    b = back @ beta
    b[0] += my
    se = np.sqrt(np.clip(np.diag(back @ cov @ back.T), 0, None))
    with np.errstate(divide="ignore", invalid="ignore"):
        t2 = (b / se) ** 2
    p_values = tuple(_f_tail(float(v), 1.0, float(dof)) if np.isfinite(v) else 0.0 for v in t2)
    sst = yy - g[0, p + 1] ** 2 / g[0, 0]
    return LinearFit(("const", *features), tuple(b), tuple(se), p_values, 1 - sse / sst if sst else np.nan, fit.n, rank)


# --- Lasso ---------------------------------------------------------------------------


@dataclass(frozen=True)
class LassoStep:
    """Coefficients at one penalty; ``violation`` is the largest breach of the optimality conditions."""

    weights: np.ndarray
    sweeps: int
    violation: float


@dataclass(frozen=True)
class LassoFit:
    """Chosen penalty, coefficients of standardised features, and how well the descent converged."""

    penalty: float
    coefficients: dict[str, float]
    sweeps: int
    violation: float
    converged: bool
    errors: tuple[float, ...]


def lasso_path(xx: np.ndarray, xy: np.ndarray, penalties: Sequence[float], tol: float = 1e-10, most_sweeps: int = 20_000) -> list[LassoStep]:
    """Coordinate descent on centred products, each penalty started from the solution of the one before.

    A sweep over all coordinates alternates with sweeps over the non-zero ones.
    Done when no optimality condition is broken by more than ``tol`` times the
    largest product, or after ``most_sweeps``.
    """
    p = len(xy)
    w, rest = np.zeros(p), np.asarray(xy, float).copy()  # rest = xy - xx w
    size = max(float(np.abs(xy).max(initial=0.0)), 1e-300)
    live = np.flatnonzero(np.diag(xx) > 1e-12 * max(np.diag(xx).max(initial=0.0), 1e-300))

    def breach(penalty: float) -> float:
        at_zero = np.maximum(np.abs(rest) - penalty, 0.0)
        off_zero = np.abs(rest - penalty * np.sign(w))
        return float(np.where(w == 0, at_zero, off_zero)[live].max(initial=0.0))

    def sweep(columns: np.ndarray, penalty: float) -> None:
        for j in columns:
            old = w[j]
            pull = rest[j] + xx[j, j] * old
            w[j] = math.copysign(max(abs(pull) - penalty, 0.0), pull) / xx[j, j]
            if w[j] != old:
                rest[:] -= xx[:, j] * (w[j] - old)

    path = []
    for penalty in penalties:
        sweeps = 0
        while True:
            sweep(live, penalty)
            sweeps += 1
            some = live[w[live] != 0]
            for _ in range(20):
                before = w[some].copy()
                sweep(some, penalty)
                sweeps += 1
                if np.abs(w[some] - before).max(initial=0.0) * np.sqrt(xx.max(initial=0.0)) <= tol * size:
                    break
            rest[:] = xy - xx @ w
            broken = breach(penalty)
            if broken <= tol * size or sweeps >= most_sweeps:
                break
        path.append(LassoStep(w.copy(), sweeps, broken / size))
    return path


def lasso_select(
    df: DataFrame, features: Sequence[str], label: str, order: Sequence[str], folds: int = 3, n_alphas: int = 100, eps: float = 1e-3, tol: float = 1e-10
) -> LassoFit:
    """Lasso on standardised features, the penalty chosen by forward-chaining folds over the row order.

    One pass yields the products of every fold segment; the products of a fold's
    training rows are those of all rows less the segments from it on.
    """
    columns = [*features, label]
    clean = df.select(*dict.fromkeys([*columns, *order])).na.drop(subset=columns)
    numbered = row_numbers(clean, list(order), "__i")
    n = numbered.count()
    size = n // (folds + 1)
    if size == 0:
        raise ValueError(f"{n} rows are too few for {folds} folds")
    first = n - folds * size
    segment = F.when(F.col("__i") <= first, 0).otherwise(F.ceil((F.col("__i") - first) / size)).cast("int")
    parts = cross_products(numbered.withColumn("__seg", segment), columns, by="__seg")
    whole = parts[0]
    for k in range(1, folds + 1):
        whole = whole + parts[k]
    p = len(features)
    _, cov = whole.centred()
    scales = np.sqrt(np.maximum(np.diag(cov), 0))
    scales = np.append(np.where(scales[:p] > 0, scales[:p], 1.0), 1.0)
    unit = np.outer(scales, scales)
    cov = cov / unit
    top = float(np.abs(cov[:p, p]).max())
    alphas = np.geomspace(top, top * eps, n_alphas) if top > 0 else np.zeros(1)
    errors = np.zeros((folds, len(alphas)))
    train = whole
    for k in range(folds, 0, -1):
        train = train - parts[k]
        offset, c = train.centred()
        offset, c = offset / scales, c / unit
        held = parts[k].g / np.outer(np.append(1.0, scales), np.append(1.0, scales))
        for a, step in enumerate(lasso_path(c[:p, :p], c[:p, p], alphas, tol)):
            v = np.concatenate([[-(offset[p] - offset[:p] @ step.weights)], -step.weights, [1.0]])
            errors[k - 1, a] = v @ held @ v / parts[k].n
    best = int(errors.mean(axis=0).argmin())
    last = lasso_path(cov[:p, :p], cov[:p, p], alphas[: best + 1], tol)[-1]
    chosen = dict(zip(features, map(float, last.weights)))
    return LassoFit(float(alphas[best]), chosen, last.sweeps, last.violation, last.violation <= tol, tuple(map(float, errors.mean(axis=0))))
