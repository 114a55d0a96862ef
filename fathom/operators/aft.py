"""Accelerated failure time models (V7): log T = x'b + sigma e with e from
the smallest extreme value (Weibull), normal (log-normal) or logistic
(log-logistic) distribution, right-censored, fitted by Newton steps.

Every step is one pass: tasks add up log-likelihood, gradient and Hessian of
their Arrow batches, and (parameters x parameters) numbers reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.session import cut_lineage


def _weibull(z, event):
    """Log density or log survival of e at z, with first and second derivative."""
    e = np.exp(np.minimum(z, 700.0))
    return np.where(event, z - e, -e), np.where(event, 1 - e, -e), -e


def _normal(z, event):
    hazard = np.exp(-0.5 * z * z - 0.5 * math.log(2 * math.pi) - _log_upper(z))
    return (np.where(event, -0.5 * z * z - 0.5 * math.log(2 * math.pi), _log_upper(z)),
            np.where(event, -z, -hazard), np.where(event, -1.0, -hazard * (hazard - z)))


def _log_upper(z):
    """log(1 - Phi(z)): the error function near 0, a continued fraction in the tail."""
    near = np.array([math.log(0.5 * math.erfc(v / math.sqrt(2))) if v < 8 else 0.0 for v in z.tolist()])
    far = np.maximum(z, 8.0)
    fraction = far.copy()
    for i in range(60, 0, -1):
        fraction = far + i / fraction
    return np.where(z < 8, near, -0.5 * far * far - 0.5 * math.log(2 * math.pi) - np.log(fraction))


def _logistic(z, event):
    p = 0.5 * (1 + np.tanh(0.5 * z))
    log_q = -np.logaddexp(0.0, z)
    return (np.where(event, z + 2 * log_q, log_q), np.where(event, 1 - 2 * p, -p), np.where(event, -2.0, -1.0) * p * (1 - p))


DISTRIBUTIONS = {"weibull": _weibull, "log_normal": _normal, "log_logistic": _logistic}
# median of e, so that a predicted median is exp(x'b + sigma median)
MEDIANS = {"weibull": math.log(math.log(2.0)), "log_normal": 0.0, "log_logistic": 0.0}


@dataclass
class AftFit:
    distribution: str
    covariates: tuple[str, ...]
    intercept: float
    coefficients: np.ndarray
    sigma: float
    log_likelihood: float
    n: int
    converged: bool

    @property
    def parameters(self) -> int:
        return len(self.coefficients) + 2

    @property
    def aic(self) -> float:
        return 2 * self.parameters - 2 * self.log_likelihood

    @property
    def bic(self) -> float:
        return self.parameters * math.log(self.n) - 2 * self.log_likelihood

    def median(self) -> Column:
        """Predicted median survival time as a column."""
        line = F.lit(self.intercept)
        for c, b in zip(self.covariates, self.coefficients):
            line = line + F.lit(float(b)) * F.col(c)
        return F.exp(line + F.lit(self.sigma * MEDIANS[self.distribution]))


def _pass(rows: DataFrame, distribution: str, theta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood, gradient and Hessian at (intercept, coefficients, log sigma)."""
    p = len(theta)
    shape = DISTRIBUTIONS[distribution]

    def run(batches):
        total = np.zeros(1 + p + p * p)
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
            y, event = cols[0], cols[1] == 1
            x = np.column_stack([np.ones(len(y)), *cols[2:]])
            sigma = math.exp(theta[-1])
            z = (y - x @ theta[:-1]) / sigma
            g, d1, d2 = shape(z, event)
            total[0] += (g - np.where(event, theta[-1] + y, 0.0)).sum()
            total[1:p] += -(x * d1[:, None]).sum(axis=0) / sigma
            total[p] += (-z * d1 - event).sum()
            h = np.zeros((p, p))
            h[:-1, :-1] = (x * d2[:, None]).T @ x / sigma ** 2
            h[:-1, -1] = h[-1, :-1] = (x * (d2 * z + d1)[:, None]).sum(axis=0) / sigma
            h[-1, -1] = (d2 * z * z + d1 * z).sum()
            total[1 + p:] += h.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["k", "v"])

    sums = rows.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(1 + p + p * p)
    for r in sums:
        total[r["k"]] = r["v"]
    return total[0], total[1:1 + p], total[1 + p:].reshape(p, p)


def fit(df: DataFrame, duration: str, event: str, covariates: Sequence[str], distribution: str = "weibull",
        steps: int = 60, tolerance: float = 1e-9) -> AftFit:
    """Maximum likelihood on rows with a positive duration and no NULL.
    Starts from least squares on log T; a step that lowers the likelihood is
    halved."""
    cov = list(covariates)
    rows = df.select(F.log(F.col(duration).cast("double")).alias("y"), F.col(event).cast("double").alias("e"),
                     *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cov)]).where(F.col(duration) > 0).dropna()
    rows = cut_lineage(rows)
    from fathom.operators.ml import gram, ridge_solve
    g = gram(rows, [f"x{i}" for i in range(len(cov))], ["y"])
    if not g["n"]:
        raise ValueError("no rows with a positive duration")
    b = ridge_solve(g, 1e-9)
    spread = max(float(g["yy"][0] - 2 * b @ g["xy"][:, 0] + b @ g["xx"] @ b) / g["n"], 1e-6)
    theta = np.append(b, 0.5 * math.log(spread))
    value, gradient, hessian = _pass(rows, distribution, theta)
    converged = False
    for _ in range(steps):
        values, vectors = np.linalg.eigh(-hessian)
        step = vectors @ ((vectors.T @ gradient) / np.maximum(np.abs(values), 1e-8 * np.abs(values).max()))
        for _ in range(40):
            found = _pass(rows, distribution, theta + step)
            if np.isfinite(found[0]) and found[0] >= value - 1e-12 * abs(value):
                break
            step = step / 2
        moved = found[0] - value
        theta = theta + step
        value, gradient, hessian = found
        if abs(moved) <= tolerance * (1 + abs(value)) and np.abs(step).max() < 1e-6:
            converged = True
            break
    return AftFit(distribution, tuple(cov), float(theta[0]), theta[1:-1], math.exp(theta[-1]), float(value), int(g["n"]), converged)
