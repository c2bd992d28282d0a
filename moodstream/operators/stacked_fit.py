"""Multinomial logistic regression for several penalties at once.

Fitting candidates one after another reads the features once per candidate and
iteration. Here every candidate runs its own L-BFGS as a generator that asks for
the loss and gradient at one point; a round stacks the points of all that are
still running and answers them in one pass over the features. The number of
jobs is that of the candidate that asks most often, whatever their number.

A pass is a tree aggregate: each task sums the losses and gradients of its rows,
about the square root of so many tasks sum those in a fixed order, and the driver
adds up theirs (all of them, if they take no more than ``DIRECT`` bytes). A partial sum holds candidates x classes x features numbers; no
row reaches the driver.

The objective is that of Spark's own estimator: the weighted mean of the log
loss plus ``reg/2`` times the squared norm of the coefficients of features scaled
to unit deviation, intercepts free. Features are centred too, which changes the
path to the optimum and not the optimum, and is done in the weights, so sparse
rows stay sparse. A feature without deviation has coefficient 0.
"""

from __future__ import annotations

import math
from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Entries of feature rows that are worked on at once.
ENTRIES = 200_000
# Bytes of partial sums that the driver adds up itself, without the stage between.
DIRECT = 64 << 20
MEMORY, ARMIJO, CURVATURE, TRIALS = 10, 1e-4, 0.9, 20


@dataclass(frozen=True)
class Fit:
    reg_param: float
    coefficients: np.ndarray  # classes x features
    intercepts: np.ndarray
    loss: float  # the objective at the end
    iterations: int


def minimise(x: np.ndarray, max_iter: int, tol: float) -> Generator[np.ndarray, tuple[float, np.ndarray], tuple[np.ndarray, float, int]]:
    """L-BFGS with a weak Wolfe line search by bisection; yields points, is sent
    (value, gradient), returns (point, value, iterations)."""
    f, g = yield x
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for n in range(max_iter):
        d, alphas = -g, []
        for s, y, rho in reversed(steps):
            alphas.append(rho * (s @ d))
            d = d - alphas[-1] * y
        if steps:
            s, y, _ = steps[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y, rho), a in zip(steps, reversed(alphas), strict=True):
            d = d + (a - rho * (y @ d)) * s
        slope = g @ d
        if slope >= 0:
            return x, f, n
        t, low, high = (1.0 if steps else 1.0 / max(1.0, float(np.sqrt(g @ g)))), 0.0, math.inf
        for _ in range(TRIALS):
            at = x + t * d
            f_at, g_at = yield at
            if not f_at <= f + ARMIJO * t * slope:
                high = t
            elif g_at @ d < CURVATURE * slope:
                low = t
            else:
                break
            t = 2 * low if high == math.inf else (low + high) / 2
        if not f_at <= f:  # no better point in reach
            return x, f, n
        s, y = at - x, g_at - g
        if s @ y > 0:
            steps = [*steps[-(MEMORY - 1):], (s, y, 1 / (s @ y))]
        done = f - f_at <= tol * max(abs(f_at), tol)
        x, f, g = at, f_at, g_at
        if done:
            return x, f, n + 1
    return x, f, max_iter


def _entries(features: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, indices, values) of the rows of unwrapped vectors; a dense one has all its places."""
    values, indices = features.field("values"), features.field("indices")
    n = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    dense = np.asarray(pc.equal(features.field("type"), 1))
    if dense.any():
        at = [np.arange(k) if full else np.asarray(i) for k, full, i in zip(n, dense, indices.to_pylist(), strict=True)]
        flat = np.concatenate(at) if at else np.empty(0, np.int64)
    else:
        flat = np.asarray(pc.list_flatten(indices))
    return n, flat.astype(np.int64), np.asarray(pc.list_flatten(values), dtype=np.float64)


def _stretches(batch: pa.RecordBatch):
    """(rows, row of each entry, indices, values) of at most about ``ENTRIES`` entries."""
    n, at, x = _entries(batch.column("_x"))
    ends = np.cumsum(n)
    lo = 0
    while lo < len(n):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + ENTRIES, side="right")))
        part = slice(int(before), int(ends[hi - 1]))
        yield slice(lo, hi), np.repeat(np.arange(hi - lo), n[lo:hi]), at[part], x[part]
        lo = hi


def _margins(weights: np.ndarray, bias: np.ndarray, rows: int, row: np.ndarray, at: np.ndarray, x: np.ndarray) -> np.ndarray:
    """rows x outputs; ``weights`` is features x outputs."""
    out = np.tile(bias, (rows, 1))
    if len(row):
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        out[row[first]] += np.add.reduceat(weights[at] * x[:, None], first, axis=0)
    return out


def _partial(points_of, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        weights, bias = points_of.value
        d, outputs = weights.shape
        many = outputs // classes
        loss, total, grad = np.zeros(many), np.zeros(outputs), np.zeros((outputs, d))
        for b in batches:
            y_all, w_all = np.asarray(b.column("_y")).astype(np.int64), np.asarray(b.column("_w"), dtype=np.float64)
            for part, row, at, x in _stretches(b):
                y, w = y_all[part], w_all[part]
                m = _margins(weights, bias, len(y), row, at, x).reshape(len(y), many, classes)
                top = m.max(axis=2, keepdims=True)
                e = np.exp(m - top)
                z = e.sum(axis=2, keepdims=True)
                loss += (w[:, None] * (np.log(z[:, :, 0]) + top[:, :, 0] - m[np.arange(len(y)), :, y])).sum(axis=0)
                p = e / z
                p[np.arange(len(y)), :, y] -= 1
                p = (p * w[:, None, None]).reshape(len(y), outputs)
                total += p.sum(axis=0)
                for j in range(outputs):
                    grad[j] += np.bincount(at, weights=p[row, j] * x, minlength=d)
        yield _packed(TaskContext.get().partitionId(), loss, total, grad)

    return run


def _packed(pid: int, *sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"pid": pa.array([pid], pa.int32()), "sums": pa.array([np.concatenate([s.ravel() for s in sums]).tobytes()], pa.binary())})


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first, total = None, None
    for b in batches:
        for pid, sums in zip(b.column("pid").to_pylist(), b.column("sums"), strict=True):
            part = np.frombuffer(sums.as_buffer(), np.float64)
            first, total = (pid, part.copy()) if total is None else (first, total + part)
    if total is not None:
        yield _packed(first, total)


def _evaluate(rows: DataFrame, tasks: int, weights: np.ndarray, bias: np.ndarray, classes: int):
    """(losses, sums of multipliers, gradients) of stacked points, summed over the rows."""
    points = rows.sparkSession.sparkContext.broadcast((np.ascontiguousarray(weights.T), bias))
    shape = "pid int, sums binary"
    parts = rows.mapInArrow(_partial(points, classes), shape)
    if tasks * (weights.size + 2 * len(bias)) * 8 > DIRECT:
        parts = parts.repartition(max(1, math.isqrt(tasks)), "pid").sortWithinPartitions("pid").mapInArrow(_added, shape)
    added = parts.collect()
    points.destroy()
    total = np.sum([np.frombuffer(r["sums"], np.float64) for r in sorted(added, key=lambda r: r["pid"])], axis=0)
    outputs, many = len(bias), len(bias) // classes
    return total[:many], total[many : many + outputs], total[many + outputs :].reshape(weights.shape)


def as_rows(df: DataFrame, features_col: str, label_col: str, weight_col: str | None = None) -> DataFrame:
    weight = F.lit(1.0) if weight_col is None else F.col(weight_col).cast("double")
    return df.select(F.unwrap_udt(features_col).alias("_x"), F.col(label_col).cast("int").alias("_y"), weight.alias("_w"))


def fit_all(df: DataFrame, reg_params: Sequence[float], classes: int, features_col: str = "_features", label_col: str = "label_id",
            weight_col: str = "weight", max_iter: int = 30, tol: float = 1e-6) -> list[Fit]:
    """One fit per ``reg_params``, in their order. ``df`` is read once for the
    scales and once per round, so it should be held (cached or written out). Labels
    are 0 to ``classes`` - 1; a class without rows gets a small share at the
    start. With an empty ``df`` there is nothing to fit and an error."""
    held = {r["y"]: r["w"] for r in df.groupBy(F.col(label_col).cast("int").alias("y")).agg(F.sum(weight_col).alias("w")).collect()}
    if not held:
        raise ValueError("no rows to learn from")
    scale = df.select(Summarizer.metrics("mean", "std").summary(F.col(features_col), F.col(weight_col)).alias("s")).first()["s"]
    mean, std, n = scale["mean"].toArray(), scale["std"].toArray(), sum(held.values())
    start = np.log(np.array([max(held.get(k, 0.0), 1e-3) for k in range(classes)]) / n)
    used = std > 0
    inverse = np.where(used, 1 / np.where(used, std, 1.0), 0.0)
    rows, d = as_rows(df, features_col, label_col, weight_col), len(mean)
    tasks = df.rdd.getNumPartitions()

    def unpack(x):
        w = x[: classes * d].reshape(classes, d) * inverse
        return w, x[classes * d :] - w @ mean

    runs = [minimise(np.r_[np.zeros(classes * d), start - start.mean()], max_iter, tol) for _ in reg_params]
    asked = {k: next(run) for k, run in enumerate(runs)}
    done: dict[int, Fit] = {}
    while asked:
        now = sorted(asked)
        points = [unpack(asked[k]) for k in now]
        loss, total, grad = _evaluate(rows, tasks, np.concatenate([w for w, _ in points]), np.concatenate([b for _, b in points]), classes)
        for i, k in enumerate(now):
            mine, x = slice(i * classes, (i + 1) * classes), asked[k]
            free, reg = x[: classes * d], reg_params[k]
            g = (grad[mine] - np.outer(total[mine], mean)) * inverse / n
            value = loss[i] / n + reg / 2 * (free @ free)
            try:
                asked[k] = runs[k].send((value, np.r_[g.ravel() + reg * free, total[mine] / n]))
            except StopIteration as end:
                x, value, rounds = end.value
                w, b = unpack(x)
                if reg == 0:
                    w = w - w.mean(axis=0)
                done[k] = Fit(reg, w, b - b.mean(), float(value), rounds)
                del asked[k]
    return [done[k] for k in range(len(reg_params))]


def _answered(stack_of, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = stack_of.value
        many = len(bias) // classes
        counts = np.zeros((many, classes, classes), np.int64)
        for b in batches:
            y_all = np.asarray(b.column("_y")).astype(np.int64)
            for part, row, at, x in _stretches(b):
                y = y_all[part]
                best = _margins(weights, bias, len(y), row, at, x).reshape(len(y), many, classes).argmax(axis=2)
                for c in range(many):
                    np.add.at(counts[c], (y, best[:, c]), 1)
        c, g, p = (i.ravel() for i in np.indices(counts.shape))
        yield pa.RecordBatch.from_pydict({"candidate": c.astype(np.int32), "gold": g.astype(np.int32), "pred": p.astype(np.int32), "n": counts.ravel()})

    return run


def confusion_counts(df: DataFrame, fits: Sequence[Fit], features_col: str, label_col: str) -> DataFrame:
    """``candidate, gold, pred, n`` of all fits in one pass, zeros included
    (class numbers; the first of equal scores is the answer)."""
    classes = len(fits[0].intercepts)
    stack = (np.ascontiguousarray(np.concatenate([f.coefficients for f in fits]).T), np.concatenate([f.intercepts for f in fits]))
    rows = as_rows(df, features_col, label_col)
    found = rows.mapInArrow(_answered(df.sparkSession.sparkContext.broadcast(stack), classes), "candidate int, gold int, pred int, n long")
    return found.groupBy("candidate", "gold", "pred").agg(F.sum("n").alias("n"))


def as_model(fit: Fit, estimator: LogisticRegression) -> LogisticRegressionModel:
    """The fit as a Spark ML model with the estimator's columns, for pipelines and saving."""
    from pyspark.sql import SparkSession

    sc = SparkSession.getActiveSession().sparkContext
    classes, d = fit.coefficients.shape
    matrix, vector = DenseMatrix(classes, d, fit.coefficients.ravel(order="F")), DenseVector(fit.intercepts)
    made = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(estimator.uid, _py2java(sc, matrix), _py2java(sc, vector), classes, True)
    return estimator._copyValues(LogisticRegressionModel(made))
