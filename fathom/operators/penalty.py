"""Penalised regression from Gram matrices (M20, E47): paths of ridge, lasso
and elastic net along a grid of penalties, and their choice by
cross-validation.

One pass over the rows gives the Gram matrix of every fold; every fit after
that works on (features x features) numbers.  Lasso and elastic net use
coordinate descent with covariance updates, warm-started from the penalty
before; ridge uses one eigendecomposition for all penalties.  The fits of
(fold, mixing share) are rows of a job of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from fathom.operators import crossval

RIDGE = 0.0           # mixing share of the squared penalty alone


def log_grid(low: float, high: float, n: int) -> list[float]:
    return [float(a) for a in np.logspace(low, high, n)]


def rescaled(gram: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Gram of [1, x, y] in standardised features, the scale that of ``total``."""
    n = total[0, 0]
    mean = total[0, 1:-1] / n
    scale = np.sqrt(np.maximum(np.diag(total)[1:-1] / n - mean * mean, 0))
    scale[scale <= 1e-12 * np.maximum(np.abs(mean), 1)] = 1.0
    t = np.eye(len(gram))
    t[0, 1:-1] = -mean / scale
    t[range(1, len(gram) - 1), range(1, len(gram) - 1)] = 1 / scale
    return t.T @ gram @ t


def _centred(gram: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, float]:
    """n, second moments of the features, with the label, means of both."""
    n = gram[0, 0]
    mean, label = gram[0, 1:-1] / n, gram[0, -1] / n
    return n, gram[1:-1, 1:-1] / n - np.outer(mean, mean), gram[1:-1, -1] / n - mean * label, mean, label


def coordinate_descent(q: np.ndarray, c: np.ndarray, penalty: float, share: float, start: np.ndarray,
                       tolerance: float = 1e-12, rounds: int = 100_000) -> np.ndarray:
    """The w with the least w'qw / 2 - c'w + penalty (share |w|_1 + (1 - share) |w|^2 / 2).

    The gradient is kept and corrected by a column of q for each coefficient
    that moves.  Rounds over all coefficients alternate with rounds over
    those above zero, until none moves the objective's scale."""
    w, p = start.copy(), len(c)
    rest = c - q @ w
    shrink, ridge = penalty * share, penalty * (1 - share)
    limit = tolerance * max(float(np.abs(c).max(initial=0)), 1e-300)
    everyone, active = range(p), None
    for _ in range(rounds):
        largest = 0.0
        for j in everyone if active is None else active:
            if q[j, j] <= 0:
                continue
            pull = rest[j] + q[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - shrink, 0.0) / (q[j, j] + ridge)
            if new != w[j]:
                step = new - w[j]
                rest -= q[:, j] * step
                w[j] = new
                largest = max(largest, abs(step) * q[j, j])
        if largest <= limit:
            if active is None:
                break
            active = None
        else:
            active = np.flatnonzero(w)
    return w


def spark_linear(gram: np.ndarray, reg: float, share: float) -> np.ndarray:
    """[1, features] of Spark's ``LinearRegression(regParam=reg,
    elasticNetParam=share, standardization=False)`` from the Gram matrix: the
    label is scaled to deviation 1, so the squared penalty is divided by it."""
    n, q, c, mean, label = _centred(gram)
    deviation = float(np.sqrt(max(gram[-1, -1] / n - label * label, 0.0)))
    if deviation == 0:
        return np.array([label, *np.zeros(len(c))])
    absolute, square = reg * share, reg * (1 - share) / deviation
    if absolute == 0:
        w = np.linalg.lstsq(q + square * np.eye(len(c)), c, rcond=None)[0]
    else:
        w = coordinate_descent(q, c, absolute + square, absolute / (absolute + square), np.zeros(len(c)))
    return np.array([label - mean @ w, *w])


@dataclass
class Search:
    """Candidates (penalty, share) with their cross-validated errors, and the refit of the best one on all rows."""

    candidates: Sequence[tuple[float, float]]
    cv_rmse: np.ndarray
    coefficients: np.ndarray          # [1, features]


def search(grams: Sequence[np.ndarray], candidates: Sequence[tuple[float, float]]) -> Search:
    """What ``CrossValidator`` finds for Spark's linear regression with RMSE:
    the mean over the folds, given by their Gram matrices; the first of equal
    candidates is refitted."""
    total = sum(grams)
    errors = []
    for test in grams:
        betas = np.array([spark_linear(total - test, *c) for c in candidates])
        errors.append(np.sqrt(mean_square(test, betas)))
    cv_rmse = np.mean(errors, axis=0)
    return Search(candidates, cv_rmse, spark_linear(total, *candidates[int(np.argmin(cv_rmse))]))


def path(gram: np.ndarray, penalties: Sequence[float], share: float) -> np.ndarray:
    """Coefficients (penalties x [1, features]) along a grid of penalties.

    Ridge (share 0) minimises |y - Xw|^2 + a |w|^2, the others
    |y - Xw|^2 / 2n + a (share |w|_1 + (1 - share) |w|^2 / 2); the intercept
    is free."""
    n, q, c, mean, label = _centred(gram)
    out = np.zeros((len(penalties), len(c) + 1))
    if share == RIDGE:
        values, vectors = np.linalg.eigh(q)
        turned = vectors.T @ c
        for i, a in enumerate(penalties):
            out[i, 1:] = vectors @ (turned / np.maximum(np.maximum(values, 0) + a / n, 1e-300))
    else:
        w = np.zeros(len(c))
        for i in np.argsort(-np.asarray(penalties), kind="stable"):      # from the largest on, each from the one before
            w = coordinate_descent(q, c, penalties[i], share, w)
            out[i, 1:] = w
    out[:, 0] = label - out[:, 1:] @ mean
    return out


def mean_square(gram: np.ndarray, betas: np.ndarray) -> np.ndarray:
    """Mean squared error of coefficients (rows of [1, features]) on the rows of a Gram matrix."""
    v = np.column_stack([-betas, np.ones(len(betas))])
    return np.maximum(np.einsum("ij,jk,ik->i", v, gram, v), 0.0) / gram[0, 0]


@dataclass
class Choice:
    """A family's penalties with their scores, and the refit of the best one on all rows."""

    family: str
    share: float
    penalty: float
    coefficients: np.ndarray          # [1, standardised features]
    train_rmse: np.ndarray            # mean over folds, per penalty
    cv_mse: np.ndarray
    cv_rmse: np.ndarray
    cv_rmse_std: np.ndarray
    paths: np.ndarray                 # penalties x [1, features], all rows

    @property
    def zeroed(self) -> int:
        return int((self.coefficients[1:] == 0).sum())


def choose(df: DataFrame, features: Sequence[str], label: str, fold: str, folds: int, penalties: Sequence[float],
           families: dict[str, Sequence[float]]) -> dict[str, Choice]:
    """For each family, given by its mixing shares, the share and penalty of
    least mean squared test error over the folds (ties: the larger penalty),
    refitted on all rows.  Features are standardised by all rows."""
    grams = crossval.fold_grams(df, features, label, {fold: folds})
    total = sum(grams.values())
    if total[0, 0] == 0:
        raise ValueError("no complete rows to fit on")
    scaled = {f: rescaled(grams[fold, f], total) for f in range(folds)}
    whole = rescaled(total, total)
    shares = sorted({s for ss in families.values() for s in ss})
    grid = list(penalties)

    def solve(frames):
        for frame in frames:
            for f, share in zip(frame["fold"], frame["share"]):
                train = sum(g for h, g in scaled.items() if h != f)
                betas = path(train, grid, share)
                test = mean_square(scaled[f], betas) if f >= 0 else np.zeros(len(grid))
                yield pd.DataFrame({"fold": f, "share": share, "at": range(len(grid)), "train": mean_square(train, betas),
                                    "test": test, "beta": list(betas)})

    spark = df.sparkSession
    jobs = [(f, float(s)) for f in range(-1, folds) for s in shares if f < 0 or scaled[f][0, 0] > 0]
    table = spark.createDataFrame(jobs, "fold int, share double").repartition(len(jobs), "fold", "share")
    rows = table.mapInPandas(solve, "fold int, share double, at int, train double, test double, beta array<double>").collect()
    by = {(r["fold"], r["share"], r["at"]): r for r in rows}        # (folds + 1) x shares x penalties
    used = sorted({f for f, _ in jobs if f >= 0})
    out = {}
    for family, mine in families.items():
        best = None
        for share in map(float, mine):
            test = np.array([[by[f, share, i]["test"] for i in range(len(grid))] for f in used])
            train = np.array([[by[f, share, i]["train"] for i in range(len(grid))] for f in used])
            mse = test.mean(axis=0)
            i = min(range(len(grid)), key=lambda j: (mse[j], -grid[j]))
            if best is None or mse[i] < best.cv_mse.min():
                paths = np.array([by[-1, share, j]["beta"] for j in range(len(grid))])
                best = Choice(family, share, grid[i], paths[i], np.sqrt(train).mean(axis=0), mse,
                              np.sqrt(test).mean(axis=0), np.sqrt(test).std(axis=0), paths)
        out[family] = best
    return out


def eliminate(gram: np.ndarray, names: Sequence[str], keep: int = 6, alpha: float = 1.0) -> list[tuple[str, float, list[str]]]:
    """Recursive elimination from one Gram matrix of [1, features,
    label]: ridge on the standardised features, drop the one with the
    smallest absolute coefficient (ties: the later name), until ``keep`` are
    left.  Returns (dropped, its coefficient, what is left) per step."""
    scaled, left, steps = rescaled(gram, gram), list(names), []
    while len(left) > max(keep, 1):
        at = [0, *[1 + list(names).index(f) for f in left], len(gram) - 1]
        w = path(scaled[np.ix_(at, at)], [alpha], RIDGE)[0, 1:]
        i = min(range(len(left)), key=lambda j: (abs(w[j]), [-ord(ch) for ch in left[j]]))
        steps.append((left[i], float(w[i]), [f for f in left if f != left[i]]))
        left = steps[-1][2]
    return steps
