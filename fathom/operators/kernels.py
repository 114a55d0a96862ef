"""Kernel feature maps (L15 random Fourier features, L16 Nyström) and
iterative imputation (L5).  Maps are small parameter tables applied to Arrow
batches inside the pass that sums the Gram matrices of the fits."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.operators import ml
from fathom.operators.ordered import quantile_row
from fathom.session import cut_lineage


@dataclass(frozen=True)
class FeatureMap:
    """Rows of features to rows of mapped features, with numpy."""

    apply: Callable[[np.ndarray], np.ndarray]


IDENTITY = FeatureMap(lambda x: x)


def random_fourier(n_features: int, n_components: int = 50, gamma: float = 0.5, seed: int = 42) -> FeatureMap:
    """RBF random Fourier features sqrt(2/D) cos(x W + b), W ~ N(0, 2
    gamma), b ~ U(0, 2 pi): a D x d parameter table from a fixed seed."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2 * gamma), size=(n_features, n_components))
    b = rng.uniform(0, 2 * math.pi, size=n_components)
    return FeatureMap(lambda x: math.sqrt(2.0 / n_components) * np.cos(x @ w + b))


def nystroem(landmarks: np.ndarray, gamma: float = 0.5) -> FeatureMap:
    """Nystroem RBF map K(x, L) U diag(1/sqrt(lambda)) from landmark rows
    L (20 to 100 of them) and the eigen-decomposition of K(L, L)."""
    def kernel(x):
        d2 = (x * x).sum(axis=1)[:, None] + (landmarks * landmarks).sum(axis=1) - 2 * x @ landmarks.T
        return np.exp(-gamma * np.maximum(d2, 0.0))

    vals, vecs = np.linalg.eigh(kernel(landmarks))
    keep = vals > 1e-10
    projection = vecs[:, keep] / np.sqrt(vals[keep])
    return FeatureMap(lambda x: kernel(x) @ projection)


def mapped_grams(df: DataFrame, features: Sequence[str], label: str, group: str, groups: Sequence[str],
                 maps: Mapping[str, FeatureMap]) -> dict[tuple[str, str], np.ndarray]:
    """Gram matrix of [1, mapped features, label] for each map and each value
    of the group column, all from one pass: the maps are computed on Arrow
    batches and never become columns.  Rows with a NULL are left out."""
    p = len(features)
    widths = {m: f.apply(np.zeros((1, p))).shape[1] + 2 for m, f in maps.items()}
    keys = [(m, g) for m in maps for g in groups]

    def run(batches):
        sums = {k: np.zeros((widths[k[0]],) * 2) for k in keys}
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(p)])
            y, g = batch.column(p).to_numpy(zero_copy_only=False), np.asarray(batch.column(p + 1).to_pylist(), dtype=object)
            for m, f in maps.items():
                z = np.column_stack([np.ones(len(y)), f.apply(x), y])
                for value in groups:
                    rows = z[g == value]
                    sums[m, value] += rows.T @ rows
        flat = np.concatenate([sums[k].ravel() for k in keys])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["k", "v"])

    rows = df.select(*[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate([*features, label])],
                     F.col(group).cast("string").alias("__g")).dropna().mapInArrow(run, "k long, v double")
    out = np.zeros(sum(widths[m] ** 2 for m, _ in keys))
    for r in rows.groupBy("k").agg(F.sum("v").alias("v")).collect():        # maps x groups x width^2 numbers
        out[r["k"]] = r["v"]
    grams, at = {}, 0
    for m, g in keys:
        grams[m, g] = out[at:at + widths[m] ** 2].reshape(widths[m], -1)
        at += widths[m] ** 2
    return grams


PATTERN_COLUMNS = 12        # up to so many columns, their patterns of missing cells are a small table


def mice(df: DataFrame, cols: Sequence[str], rounds: int = 10, start: Mapping[str, float] | None = None) -> DataFrame:
    """Chained-equation imputation.  Start from the median (or ``start``);
    each round, for each column, a Bayesian ridge fit on the rows where it was
    observed predicts the rows where it was missing.

    A filled cell is a linear function of its row's observed cells, the same
    one for all rows with the same cells missing.  So the Gram matrices of
    the fits come from those of the observed cells by pattern of missing
    cells: one pass sums these, the rounds change one matrix a pattern, and
    one more pass fills the cells.  Above ``PATTERN_COLUMNS`` columns each fit
    has a pass of its own."""
    cols = list(cols)
    if start is None:
        med = quantile_row(df, cols, [0.5], prefix="").first()
        start = {c: med[c][0] if med[c] else 0.0 for c in cols}
    if len(cols) > PATTERN_COLUMNS:
        return _mice_by_rows(df, cols, rounds, start)
    p = len(cols)
    missing = (np.arange(2 ** p)[:, None] >> np.arange(p)) % 2 == 1
    pattern = sum((F.col(c).isNull().cast("int") * (1 << j) for j, c in enumerate(cols)), F.lit(0))
    seen = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols}
    grams = np.zeros((2 ** p, p + 1, p + 1))
    for at, g in ml.gram_by(df.select(pattern.alias("__pattern"), *[v.alias(c) for c, v in seen.items()]), cols, [],
                            "__pattern").items():
        grams[at] = g["xx"]
    now = np.broadcast_to(np.eye(p + 1), grams.shape).copy()       # from [1, observed cells] to [1, cells]
    for j, c in enumerate(cols):
        now[missing[:, j], j + 1] = np.eye(p + 1)[0] * float(start[c])
    for _ in range(rounds):
        for j in range(1, p + 1):
            own, rest = missing[:, j - 1], [o for o in range(p + 1) if o != j]
            g = (now[~own] @ grams[~own] @ now[~own].transpose(0, 2, 1)).sum(axis=0)
            fit = ml.bayesian_ridge({"n": g[0, 0], "xx": g[np.ix_(rest, rest)], "xy": g[rest, j][:, None], "yy": g[[j], j]})
            now[own, j] = np.einsum("o,mok->mk", [fit["intercept"], *fit["coef"]], now[own][:, rest])
    # a null in place of the rows of observed cells: they stay as they are
    table = df.sparkSession.createDataFrame(
        [(int(m), [now[m, j + 1].tolist() if missing[m, j] else None for j in range(p)]) for m in range(2 ** p)],
        "__pattern int, __fill array<array<double>>")
    values = [F.lit(1.0), *[f"__seen_{c}" for c in cols]]
    fill = {c: sum((F.col("__fill")[j][k] * (F.col(v) if k else v) for k, v in enumerate(values)), F.lit(0.0))
            for j, c in enumerate(cols)}
    return df.withColumns({"__pattern": pattern, **{f"__seen_{c}": v for c, v in seen.items()}}) \
        .join(F.broadcast(table), "__pattern") \
        .withColumns({c: F.when(F.col(c).isNull(), fill[c]).otherwise(F.col(c)) for c in cols}).select(*df.columns)


def _mice_by_rows(df: DataFrame, cols: list[str], rounds: int, start: Mapping[str, float]) -> DataFrame:
    """``mice`` with a pass over the rows for each fit; each round is checkpointed so the lineage stays short."""
    cur = df.withColumns({f"__miss_{c}": F.col(c).isNull() for c in cols}) \
        .withColumns({c: F.coalesce(F.col(c), F.lit(float(start[c]))) for c in cols})
    cur = cut_lineage(cur)
    for _ in range(rounds):
        for c in cols:
            others = [o for o in cols if o != c]
            g = ml.gram(cur.where(~F.col(f"__miss_{c}")), others, [c])
            fit = ml.bayesian_ridge(g)
            pred = F.lit(float(fit["intercept"]))
            for o, b in zip(others, fit["coef"]):
                pred = pred + F.lit(float(b)) * F.col(o)
            cur = cur.withColumn(c, F.when(F.col(f"__miss_{c}"), pred).otherwise(F.col(c)))
        cur = cut_lineage(cur)
    return cur.drop(*[f"__miss_{c}" for c in cols])
