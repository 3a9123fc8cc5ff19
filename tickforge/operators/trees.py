"""All tree trials on all folds in one job (H3).

A fold of a search is short (``2 * window`` rows of each ticker), and MLlib takes several Spark jobs for each level of each tree.
Here every fold is one group of rows, and a task boosts all trials on it.  The method is that of MLlib's
``GBTRegressor`` with squared error: features cut into at most ``BINS`` bins at quantiles of the training rows, trees grown level by
level by the gain in variance, rows drawn anew for each tree (``subsamplingRate``) and features for each node
(``featureSubsetStrategy``), a first tree of weight 1 and later ones of weight ``stepSize``, and an end at the first gain below
``tol`` on the validation rows.  Without draws the errors equal MLlib's (tested); with them the drawn rows differ.

A group is held by one task, so folds of more than ``CELLS`` values are left to MLlib's distributed fit (``learn.search_params``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickforge.operators.search import dealt

#: Most values (rows x features) of a fold that one task takes; MLlib's bins; histogram cells at a time.
CELLS, BINS, BLOCK = 1 << 23, 32, 1 << 19
LEAST_IMPURITY = 2.0 ** -52


def cuts(x: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds between the distinct values of ``x``, at quantiles."""
    values, counts = np.unique(x, return_counts=True)
    if len(values) - 1 <= most:
        return (values[1:] + values[:-1]) / 2.0
    stride = len(x) / (most + 1)
    out, seen, target = [], 0, stride
    for k in range(len(values) - 1):
        seen += counts[k]
        if abs(seen - target) < abs(seen + counts[k + 1] - target):
            out.append((values[k] + values[k + 1]) / 2.0)
            target += stride
    return np.array(out)


def features_each(strategy: str, d: int) -> int:
    """Features that a node draws of ``d``, by MLlib's names for it."""
    named = {"all": d, "auto": d, "sqrt": math.ceil(math.sqrt(d)), "log2": max(1, math.ceil(math.log2(d))), "onethird": math.ceil(d / 3)}
    if strategy in named:
        return named[strategy]
    return min(d, int(strategy)) if strategy.isdigit() else math.ceil(float(strategy) * d)


class Tree:
    """Nodes as lists: the feature and bin that rows go left up to (-1: leaf), the left child (the right one is next), the value."""

    def __init__(self):
        self.feature, self.cut, self.left, self.value = [], [], [], []

    def add(self, value: float) -> int:
        for x, y in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.value, value)):
            x.append(y)
        return len(self.value) - 1

    def predict(self, bins: np.ndarray) -> np.ndarray:
        feature, cut, left = np.array(self.feature), np.array(self.cut), np.array(self.left)
        at, go = np.zeros(len(bins), int), np.arange(len(bins))
        while len(go):
            go = go[feature[at[go]] >= 0]
            n = at[go]
            at[go] = left[n] + (bins[go, feature[n]] > cut[n])
        return np.array(self.value)[at]


def _histograms(bins: np.ndarray, node: np.ndarray, y: np.ndarray, nodes: int) -> np.ndarray:
    """(3, nodes, features, BINS): rows, sums and squared sums of ``y``."""
    d = bins.shape[1]
    out = np.zeros((3, nodes * d * BINS))
    step = max(1, BLOCK // d)
    for s in range(0, len(bins), step):
        at = ((node[s:s + step, None] * d + np.arange(d)) * BINS + bins[s:s + step]).ravel()
        part = np.repeat(y[s:s + step], d)
        for k, w in enumerate((None, part, part * part)):
            out[k] += np.bincount(at, w, minlength=out.shape[1])
    return out.reshape(3, nodes, d, BINS)


def _best(h: np.ndarray, n_cuts: np.ndarray, each: int, least: int, gain: float, rng: np.random.Generator):
    """(gain, feature, bin, left's rows, left's sum, left's squared sum) of the best split of each node."""
    left = h.cumsum(axis=3)
    total = left[:, :, :1, -1:]
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = lambda s: (s[2] - s[1] * s[1] / s[0]) / total[0]
        g = spread(total) - spread(left) - spread(right)
        bad = (left[0] < least) | (right[0] < least) | ~(g >= gain) | (np.arange(BINS) >= n_cuts[:, None])
    if each < h.shape[2]:
        drawn = np.argsort(rng.random(h.shape[1:3]), axis=1)[:, :each]
        out = np.ones(h.shape[1:3], bool)
        np.put_along_axis(out, drawn, False, axis=1)
        bad |= out[:, :, None]
    g = np.where(bad, -np.inf, g).reshape(len(g), -1)
    at = g.argmax(axis=1)
    row = np.arange(len(g))
    return g[row, at], at // BINS, at % BINS, left.reshape(3, len(g), -1)[:, row, at]


def grow(bins: np.ndarray, y: np.ndarray, n_cuts: np.ndarray, depth: int, each: int, least: int, gain: float,
         rng: np.random.Generator) -> Tree:
    tree = Tree()
    tree.add(float(y.mean()) if len(y) else 0.0)
    node, ids = np.zeros(len(y), int), [0]
    todo = {0: (len(y), float(y.sum()), float(y @ y))}
    for _ in range(depth):
        open_ = [i for i in ids if todo[i][0] >= 2 * least and todo[i][2] - todo[i][1] ** 2 / todo[i][0] > LEAST_IMPURITY * todo[i][0]]
        ids = []
        size = max(1, BLOCK // (bins.shape[1] * BINS))
        for s in range(0, len(open_), size):
            group = open_[s:s + size]
            place = np.full(len(tree.value), -1)
            place[group] = np.arange(len(group))
            rows = np.flatnonzero(place[node] >= 0)
            best, feature, cut, left = _best(_histograms(bins[rows], place[node[rows]], y[rows], len(group)), n_cuts, each, least, gain, rng)
            for k, i in enumerate(group):
                if not best[k] > 0:
                    continue
                lower = tuple(left[:, k].tolist())
                upper = tuple(a - b for a, b in zip(todo[i], lower))
                tree.feature[i], tree.cut[i], tree.left[i] = int(feature[k]), int(cut[k]), len(tree.value)
                for part in (lower, upper):
                    child = tree.add(part[1] / part[0])
                    todo[child] = part
                    ids.append(child)
        if not ids:
            break
        feature, cut, left = np.array(tree.feature), np.array(tree.cut), np.array(tree.left)
        rows = np.flatnonzero(feature[node] >= 0)
        n = node[rows]
        node[rows] = left[n] + (bins[rows, feature[n]] > cut[n])
    return tree


def boosted_error(x: np.ndarray, y: np.ndarray, valid: np.ndarray, p: dict, rng: np.random.Generator, tol: float) -> float | None:
    """Root mean squared error on the ``valid`` rows of trees boosted on the others (parameters as in ``learn.gbt``)."""
    train = ~valid
    if not train.any() or not valid.any():
        return None
    each = features_each(str(p.get("colsample_bytree", "all")), x.shape[1])
    most = min(BINS, int(train.sum())) - 1
    edges = [cuts(x[train, j], most) for j in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.uint8)
    n_cuts = np.array([len(e) for e in edges])
    share, rate = float(p.get("subsample", 1.0)), float(p.get("eta", 0.3))
    at, yhat, best = np.flatnonzero(train), np.zeros(len(y)), None
    for m in range(int(p.get("rounds", 10))):
        goal = y[at] if not m else 2.0 * (y[at] - yhat[at])
        took = rng.random(len(at)) < share if share < 1.0 else slice(None)
        tree = grow(bins[at[took]], goal[took], n_cuts, int(p.get("max_depth", 6)), each, int(p.get("min_child_weight", 1)),
                    float(p.get("gamma", 0.0)), rng)
        yhat += (rate if m else 1.0) * tree.predict(bins)
        error = float(np.mean((y[valid] - yhat[valid]) ** 2))
        if best is not None and best - error < tol * max(error, 0.01):
            break
        best = error
    return None if best is None else math.sqrt(best)


def tree_errors(rows: DataFrame, trials: Sequence[tuple[int, dict]], folds: int, seed: int = 42, tol: float = 0.01) -> DataFrame:
    """(trial, fold, rmse) of the ``trials`` (number, parameters) on ``rows`` (fold, role, x: features with the label last) of
    ``folds`` folds."""
    todo = list(trials)

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        fold = key[0].as_py()
        x = np.asarray(t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False), float).reshape(t.num_rows, -1)
        x = np.ascontiguousarray(x) + 0.0                          # one zero
        order = x.view(np.dtype((np.void, x.itemsize * x.shape[1]))).ravel().argsort(kind="stable")
        valid = np.array([r == "valid" for r in t.column("role").to_pylist()])[order]
        x, y = x[order, :-1], x[order, -1]
        errors = [boosted_error(x, y, valid, p, np.random.default_rng([seed, k, fold]), tol) for k, p in todo]
        return pa.table({"trial": pa.array([k for k, _ in todo], pa.int32()), "fold": pa.array([fold] * len(todo), pa.int32()),
                         "rmse": pa.array(errors, pa.float64())})

    return dealt(rows, folds).groupBy("fold").applyInArrow(run, "trial int, fold int, rmse double")
