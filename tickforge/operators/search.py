"""All linear trials on all folds from one pass over the rows (H3).

A linear model's fit and its squared error need no rows, only sums: the number of rows, the means, and the centred
products of all features and the label.  They are summed once for each (fold, role):

1. the design vectors (null rule, ticker, indicators) are made by the same ML stages that a single fit uses;
2. rows are dealt into groups of about ``GROUP_ROWS`` within (fold, role) and each group gives one partial sum (a matrix of
   d x d doubles, however many rows it has);
3. each fold's partial sums are added (pairwise update of means and centred products, which does not cancel), every trial is
   solved from the training sums by coordinate descent and solves for its signs, and its error is read off the validation sums.

The problem solved is the one MLlib's normal-equation solver states: squares / 2n + regParam * (a * |w| + (1 - a) / 2 * w^2) in
features and label scaled to unit variance (population), with the penalty divided by the label's deviation; constant
features have weight 0.  Rows without a label take no part.  A fold without training or validation rows has no error (null).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a partial sum; sweeps over the weights, and the change below which they stop.
GROUP_ROWS, SWEEPS, STILL = 4096, 2000, 1e-10
#: Least l2 beside an l1 penalty (C has a unit diagonal): one answer where features depend on each other exactly.
LEAST_RIDGE = 1e-9

STATS = "fold int, role string, n long, mean array<double>, products array<double>"


def added(parts: Sequence[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Sum of partial sums (rows, means, centred products)."""
    n, mean, products = 0, None, None
    for m, mu, p in parts:
        if not m:
            continue
        if not n:
            n, mean, products = m, mu.copy(), p.copy()
            continue
        off = mu - mean
        products += p + np.outer(off, off) * (n * m / (n + m))
        mean += off * (m / (n + m))
        n += m
    return n, mean, products


def fold_sums(rows: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Partial sums (``STATS``) of ``rows`` (fold, role, x: array of features with the label last)."""
    parts = (rows.groupBy("fold", "role").agg(F.ceil(F.count(F.lit(1)) / group_rows).cast("int").alias("parts")))
    dealt = (rows.join(parts, ["fold", "role"])
             .withColumn("part", F.pmod(F.xxhash64("x"), F.col("parts")).cast("int")).drop("parts"))

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        fold, role, _ = (k.as_py() for k in key)
        x = np.asarray(t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False), float).reshape(t.num_rows, -1)
        mean = x.mean(axis=0)
        x = x - mean
        return pa.table({"fold": pa.array([fold], pa.int32()), "role": [role], "n": pa.array([len(x)], pa.int64()),
                         "mean": [mean], "products": [(x.T @ x).ravel()]})

    return dealt.select("fold", "role", "part", "x").groupBy("fold", "role", "part").applyInArrow(run, STATS)


def solve(n: int, mean: np.ndarray, products: np.ndarray, reg: float, mix: float) -> tuple[np.ndarray, float]:
    """(weights, intercept) of the elastic net with regParam ``reg`` and elasticNetParam ``mix``; the label is the last column."""
    var = np.diag(products) / n
    sd = np.sqrt(np.maximum(var, 0.0))
    d = len(mean) - 1
    weights = np.zeros(d)
    live = np.flatnonzero(sd[:d] > 1e-12 * np.maximum(1.0, np.abs(mean[:d])))
    if sd[d] > 0 and len(live):
        c = products[np.ix_(live, live)] / n / np.outer(sd[live], sd[live])
        q = products[live, d] / n / (sd[live] * sd[d])
        l1, l2 = mix * reg / sd[d], (1 - mix) * reg / sd[d]
        weights[live] = _descend(c, q, l1, l2) * sd[d] / sd[live]
    return weights, float(mean[d] - weights @ mean[:d])


def _descend(c: np.ndarray, q: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """Least of w'Cw / 2 - q'w + l1 |w| + l2 w^2 / 2 (C has a unit diagonal): sweeps of coordinate descent find the weights that are not
    zero and their signs, a solve gives the least among weights of these signs, and so on until no weight outside wants to move."""
    if l1 == 0:
        return np.linalg.lstsq(c + l2 * np.eye(len(q)), q, rcond=1e-12)[0]
    l2 = max(l2, LEAST_RIDGE)
    w, gap = np.zeros(len(q)), q.copy()                    # gap = q - Cw
    for _ in range(SWEEPS):
        most = 0.0
        for j in range(len(q)):
            z = gap[j] + w[j]
            new = np.sign(z) * max(abs(z) - l1, 0.0) / (1.0 + l2)
            step = new - w[j]
            if step:
                gap -= c[j] * step
                w[j] = new
                most = max(most, abs(step))
        if most < STILL:
            break
        w = _settled(c, q, l1, l2, w)
        gap = q - c @ w
        if np.all(np.abs(gap - l2 * w - l1 * np.sign(w)) <= np.where(w != 0, STILL, l1 + STILL)):
            break
    return w


def _solved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x of ax = b (a symmetric); the shortest one where ``a`` is not positive definite."""
    try:
        low = np.linalg.cholesky(a)
        if low.diagonal().min() > 1e-6:
            return np.linalg.solve(a, b)
    except np.linalg.LinAlgError:
        pass
    return np.linalg.lstsq(a, b, rcond=1e-12)[0]


def _settled(c: np.ndarray, q: np.ndarray, l1: float, l2: float, w: np.ndarray) -> np.ndarray:
    """From ``w`` towards the least among weights of its signs; weights that reach zero on the way stay there."""
    w = w.copy()
    while len(at := np.flatnonzero(w)):
        sign, old = np.sign(w[at]), w[at]
        new = _solved(c[np.ix_(at, at)] + l2 * np.eye(len(at)), q[at] - l1 * sign)
        if np.all(new * sign > 0):
            w[at] = new
            break
        far = np.where(new * sign > 0, np.inf, old / np.where(old == new, 1.0, old - new))
        far[(old == new) & (new * sign <= 0)] = 0.0
        share = far.min()
        moved = old + share * (new - old)
        moved[far <= share] = 0.0
        w[at] = moved
    return w


def squared_error(n: int, mean: np.ndarray, products: np.ndarray, weights: np.ndarray, intercept: float) -> float:
    """Sum of squared errors over the rows of the sums."""
    v = np.append(-weights, 1.0)
    return float(max(0.0, v @ products @ v) + n * (mean @ v - intercept) ** 2)


def dealt(rows: DataFrame, folds: int) -> DataFrame:
    """``rows`` dealt by fold over a number of tasks, so that small folds are not put into one."""
    return rows.repartition(max(1, min(folds, 8 * rows.sparkSession.sparkContext.defaultParallelism)), "fold")


def linear_errors(sums: DataFrame, trials: Sequence[tuple[int, float, float]], folds: int = 200) -> DataFrame:
    """(trial, fold, rmse) of the ``trials`` (number, regParam, elasticNetParam) from the sums of ``folds`` folds."""
    todo = list(trials)

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        by = {"train": [], "valid": []}
        for role, n, mean, products in zip(*(t.column(c).to_pylist() for c in ("role", "n", "mean", "products"))):
            by[role].append((n, np.array(mean), np.array(products).reshape(len(mean), -1)))
        train, valid = added(by["train"]), added(by["valid"])
        errors = []
        for _, reg, mix in todo:
            if not train[0] or not valid[0]:
                errors.append(None)
                continue
            errors.append(float(np.sqrt(squared_error(*valid, *solve(*train, reg, mix)) / valid[0])))
        return pa.table({"trial": pa.array([k for k, _, _ in todo], pa.int32()),
                         "fold": pa.array([key[0].as_py()] * len(todo), pa.int32()), "rmse": pa.array(errors, pa.float64())})

    return dealt(sums, folds).groupBy("fold").applyInArrow(run, "trial int, fold int, rmse double")


def design(assembled: DataFrame, label: str) -> DataFrame:
    """(fold, role, x) of rows with the ML column ``features``; x has the label last."""
    return assembled.select("fold", "role", F.concat(vector_to_array("features"), F.array(F.col(f"`{label}`").cast("double")))
                            .alias("x"))
