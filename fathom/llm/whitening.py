"""Whitening of embeddings by mixed-precision eigenvectors of their covariance.

Vectors become whole numbers on a grid (``floor(64 c) + 1000000``), so counts,
sums and the covariance of the distinct ones, the fit list, are exact: tasks add
up products of numbers centred at the nearest whole mean, Spark adds the sums of
the tasks as decimals, and the remainder of the mean goes out as a fraction.
Float32 eigenvectors of the covariance are then corrected by Ogita and Aishima's
iteration, matrix products in extended precision that double the right digits a
step.  Eigenvalues too close for a step to part are a cluster: its vectors are
turned by the eigenvectors of a small problem of their own, shifted by the
cluster's mean, after which the next steps part them.  Only sums over dimensions
by dimensions reach the driver.

Defined results: a row whose vector is null, or holds a null, NaN or infinite
entry, is left out, and so is one whose length is not the most frequent length
above 0 (of ties the larger).  64 c is kept within +-2^53.  Repeated vectors
count once in the fit and are all whitened; ids are carried untouched.  A
direction without variance has no component, so one vector alone gives rows
without components; an empty table gives none.  A ``deviation`` beyond the range
of a long is null.  Columns called ``deviation`` or ``whitened`` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom.llm.registry import query, table
from fathom.llm.stored import stored

GRID, ORIGIN = 64, 1_000_000
COMPONENTS = 16
LARGEST = float(1 << 53)
_X = "__grid"
WIDE = np.longdouble


@dataclass
class Whitening:
    """What the fit list says: sizes, mean, leading components and how white they make it."""

    n: int
    dim: int
    centre: np.ndarray       # whole numbers next to the means
    rest: list[int]          # sums minus n times the centre
    values: np.ndarray       # eigenvalues, falling
    vectors: np.ndarray      # dim x components
    trace: float
    identity_error: float | None = None

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)

    @property
    def offset(self) -> np.ndarray:
        return np.array([float(Fraction(r, max(self.n, 1))) for r in self.rest])


def on_grid(vector: Column) -> Column:
    """The entries as whole numbers."""
    def step(c):
        scaled = F.lit(float(GRID)) * c.cast("double")
        return F.floor(F.greatest(F.least(scaled, F.lit(LARGEST)), F.lit(-LARGEST))) + F.lit(ORIGIN)

    return F.transform(vector, step)


def _usable(vector: Column) -> Column:
    inf = F.lit(float("inf"))
    entry = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < inf)
    return vector.isNotNull() & F.forall(vector, entry)


def _dimension(df: DataFrame, vector_col: str) -> int:
    sizes = df.where(_usable(F.col(vector_col))).groupBy(F.size(vector_col).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.where("d > 0").orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return int(most[0]["d"]) if most else 0


def _block(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(x: np.ndarray) -> list[int]:
    """Exact column sums as Python integers."""
    top = int(np.abs(x).max(initial=0))
    return [int(s) for s in (x if top * len(x) < 1 << 62 else x.astype(object)).sum(axis=0)]


def _products(y: np.ndarray) -> np.ndarray:
    """Exact y'y of whole numbers, as Python integers."""
    top = int(np.abs(y).max(initial=0))
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    if top * top >= 1 << 53:
        wide = y.astype(object)
        return total + wide.T @ wide
    rows = max(1, (1 << 53) // max(1, top * top))       # so many rows at once are exact in float64
    for i in range(0, len(y), rows):
        part = y[i:i + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _exact(frame: DataFrame, key: str, value: str) -> dict[int, int]:
    """Sums of the whole numbers, written as text, of each key."""
    summed = frame.groupBy(key).agg(F.try_sum(F.col(value).cast("decimal(38,0)")).alias("s"))
    found = {r[key]: r["s"] for r in summed.collect()}
    if any(s is None for s in found.values()):
        raise OverflowError("a sum has more than 38 digits")
    return {k: int(s) for k, s in found.items()}


def _moments(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    def run(batches):
        n, sums = 0, [0] * dim
        for batch in batches:
            x = _block(batch.column(0), dim)
            n += len(x)
            sums = [a + b for a, b in zip(sums, _sums(x))] if len(x) else sums
        keys = pa.array(range(-1, dim), type=pa.int32())
        yield pa.RecordBatch.from_arrays([keys, pa.array(map(str, [n, *sums]), type=pa.string())], names=["i", "v"])

    found = _exact(fit.select(_X).mapInArrow(run, "i int, v string"), "i", "v")
    return found.get(-1, 0), [found.get(i, 0) for i in range(dim)]


def _gram(fit: DataFrame, dim: int, centre: np.ndarray) -> list[list[int]]:
    upper = np.triu_indices(dim)

    def run(batches):
        total = np.zeros((dim, dim), dtype=object)
        for batch in batches:
            if batch.num_rows:
                total = total + _products(_block(batch.column(0), dim) - centre)
        keys = pa.array(range(len(upper[0])), type=pa.int32())
        yield pa.RecordBatch.from_arrays([keys, pa.array(map(str, total[upper]), type=pa.string())], names=["i", "v"])

    found = _exact(fit.select(_X).mapInArrow(run, "i int, v string"), "i", "v")
    out = [[0] * dim for _ in range(dim)]
    for at, (i, j) in enumerate(zip(*upper)):
        out[i][j] = out[j][i] = found.get(at, 0)
    return out


def _covariance(gram: list[list[int]], rest: list[int], n: int) -> np.ndarray:
    """Exact quotients, rounded once to extended precision."""
    dim = len(rest)
    out = np.zeros((dim, dim), dtype=WIDE)
    for i in range(dim):
        for j in range(i, dim):
            exact = Fraction(n * gram[i][j] - rest[i] * rest[j], n * n)
            high = float(exact)
            out[i, j] = out[j, i] = WIDE(high) + WIDE(float(exact - Fraction(high)))
    return out


def _clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Groups of two or more values whose neighbours lie within the width."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > width) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def refined(matrix: np.ndarray, vectors: np.ndarray, most: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of a symmetric matrix, from rough vectors, in extended precision."""
    a, x = matrix.astype(WIDE), vectors.astype(WIDE)
    size = np.sqrt((a * a).sum())
    one, small = np.eye(len(a), dtype=WIDE), 16 * np.finfo(WIDE).eps
    values = np.diag(a).copy()
    if size == 0:
        return values, one
    last = np.inf
    for _ in range(most):
        r = one - x.T @ x
        s = x.T @ a @ x
        r, s = (r + r.T) / 2, (s + s.T) / 2      # rounding apart, or close values would magnify it
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        width = 2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum()))
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= width
        step = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, WIDE(1), gap))
        x = x + x @ step
        for group in _clusters(values, width):
            x[:, group] = x[:, group] @ _turn(a, x[:, group])
        change = np.abs(step).max()
        if change <= small or (change <= 1e-15 and change >= last / 2):
            break
        last = change
    return np.diag(x.T @ a @ x) / np.diag(x.T @ x), x / np.sqrt((x * x).sum(axis=0))


def _turn(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Eigenvectors of the small problem that a cluster's vectors span, shifted by the cluster's mean."""
    mean = np.diag(x.T @ a @ x).sum() / (x * x).sum()
    small = x.T @ (a @ x - mean * x)
    spread = np.abs(small).max()
    if spread == 0:
        return np.eye(x.shape[1], dtype=WIDE)
    small = (small + small.T) / 2
    turn = np.linalg.eigh((small / spread).astype(np.float64))[1].astype(WIDE)
    return turn @ (1.5 * np.eye(len(turn), dtype=WIDE) - 0.5 * (turn.T @ turn))    # orthogonal beyond double precision


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvalues and vectors, values falling, each vector's largest entry positive."""
    top = np.abs(covariance).max(initial=0)
    if top == 0:
        return np.zeros(0), np.zeros((len(covariance), 0))
    rough = np.linalg.eigh((covariance / top).astype(np.float32))[1]
    values, vectors = refined(covariance / top, rough)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > len(covariance) * 2.0 ** -50 * values.max()]
    vectors = vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return (values[order] * top).astype(np.float64), (vectors * signs).astype(np.float64)


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the covariance of the whitened fit list minus the identity."""
    dim, k, centre, offset, projection = model.dim, len(model.values), model.centre, model.offset, model.projection

    def run(batches):
        total = np.zeros((k + 1, k))
        for batch in batches:
            z = ((_block(batch.column(0), dim) - centre) - offset) @ projection
            total[:k] += z.T @ z
            total[k] += z.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), type=pa.int32()), pa.array(total.ravel())], names=["i", "v"])

    sums = fit.select(_X).mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((k + 1) * k)
    for r in sums:
        total[r["i"]] = r["v"]
    total = total.reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def fit(df: DataFrame, vector_col: str = "embedding", most: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct usable vectors of df, with at most so many components."""
    dim = _dimension(df, vector_col)
    if not dim:
        return Whitening(0, 0, np.zeros(0, dtype=np.int64), [], np.zeros(0), np.zeros((0, 0)), 0.0)
    grid = _gridded(df, vector_col, dim).select(_X)
    listed = stored(grid.distinct(), "fit-list")
    n, sums = _moments(listed, dim)
    centre = [round(Fraction(s, n)) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]
    centre = np.array(centre, dtype=np.int64)
    covariance = _covariance(_gram(listed, dim, centre), rest, n)
    values, vectors = components(covariance, most)
    model = Whitening(n, dim, centre, rest, values, vectors, float(np.trace(covariance)))
    if len(values):
        model.identity_error = _identity_error(listed, model)
    return model


def _gridded(df: DataFrame, vector_col: str, dim: int) -> DataFrame:
    vector = F.col(vector_col)
    return df.where(_usable(vector) & (F.size(vector) == dim)).withColumn(_X, on_grid(vector))


def _deviations(y: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """Sum over dimensions of (n y - rest)^2, exact; null beyond a long."""
    top = int(np.abs(y).max(initial=0)) * n + max(map(abs, rest))
    if top * top * y.shape[1] < 1 << 63:
        d = y * n - np.array(rest, dtype=np.int64)
        return (d * d).sum(axis=1).tolist()
    d = y.astype(object) * n - np.array(rest, dtype=object)
    return [int(s) if s < 1 << 63 else None for s in (d * d).sum(axis=1)]


def transform(df: DataFrame, model: Whitening, vector_col: str = "embedding") -> DataFrame:
    """The usable rows of df with ``deviation`` and ``whitened``, an array with a number for each component."""
    made = [T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    kept = [f for f in df.schema if f.name not in ("deviation", "whitened")]
    schema = T.StructType([*kept, *made])
    if not model.n:
        return df.sparkSession.createDataFrame([], schema)
    n, dim, centre, rest = model.n, model.dim, model.centre, model.rest
    offset, projection = model.offset, model.projection

    def run(batches):
        for batch in batches:
            y = _block(batch.column(_X), dim) - centre
            white = np.ascontiguousarray((y - offset) @ projection)
            ends = pa.array(np.arange(len(y) + 1, dtype=np.int32) * white.shape[1])
            cols = {f.name: batch.column(f.name) for f in kept}
            cols["deviation"] = pa.array(_deviations(y, n, rest), type=pa.int64())
            cols["whitened"] = pa.ListArray.from_arrays(ends, pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return _gridded(df, vector_col, dim).mapInArrow(run, schema)


@query("op11_mixed_precision_whitening")
def op11_mixed_precision_whitening(spark, sf_dir):
    """A row for each usable vector and component."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit(vectors)
    share = F.array(*[F.lit(float(v) / model.trace) for v in model.values]) if len(model.values) else F.array().cast("array<double>")
    white = transform(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return white.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
                        "deviation", "whitened", F.get(share, F.col("at")).alias("explained"),
                        F.lit(model.identity_error).cast("double").alias("identity_error"))
