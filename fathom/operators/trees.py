"""Regression trees, forests and boosted trees, many fits at a time.

The learners of Spark ML (``DecisionTreeRegressor``, ``RandomForestRegressor``,
``GBTRegressor``): candidate thresholds from the counts of the values
(``maxBins``), variance gain, ``minInstancesPerNode`` and ``minInfoGain``,
Poisson bootstrap and random features per node, boosting of squared error.
Spark fits one model after the other, each with passes and cached rows of its
own; here

* rows are stored once, as the code of their cell (the bins of all features),
  their label and their fold numbers;
* all trees of all fits, on all splits of all schemes, grow a level in one
  pass.  A block of rows is summed by cell once for each bootstrap and fold
  column, and the trees' histograms are made from those sums;
* boosted trees need the sums by cell alone; where these are at most ``LOCAL``
  they are grown on the driver, otherwise in passes like the others;
* all models are scored in one pass.

Candidate thresholds are those of all rows given, not of each split; a row's
bootstrap weight is a hash of its number, the seed and the tree, so splits
share it.
"""

from __future__ import annotations

import math
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.operators import ordered
from fathom.session import cut_lineage, stored

BLOCK = 1 << 19                     # rows that a task takes together
LOCAL = 1 << 20                     # sums by cell and fold that may come to the driver
VALUES = 200_000                    # distinct values of all features that may come to the driver
GRID = 1 << 22                      # cells up to which a block's cells are found by a table of all


@dataclass(frozen=True)
class Spec:
    """What an estimator asks for."""

    kind: str                       # tree, forest or boosting
    depth: int
    bins: int
    least: int                      # rows of a child
    gain: float
    seed: int
    trees: int = 1
    features: str = "all"
    bootstrap: bool = False
    step: float = 1.0

    def some(self, p: int) -> int:
        """Number of features that a node may split on."""
        s = self.features
        if s == "auto":
            s = "all" if self.trees == 1 else "onethird"
        named = {"all": p, "sqrt": math.ceil(math.sqrt(p)), "log2": math.ceil(math.log2(p)) if p > 1 else 1,
                 "onethird": math.ceil(p / 3)}
        if s in named:
            return max(1, min(p, named[s]))
        return max(1, min(p, int(s))) if s.isdigit() else max(1, math.ceil(float(s) * p))


def spec(estimator) -> Spec | None:
    """The estimator's settings; None where it is none of the three, or asks for something that is not done here."""
    kinds = {DecisionTreeRegressor: "tree", RandomForestRegressor: "forest", GBTRegressor: "boosting"}
    kind = kinds.get(type(estimator))
    if kind is None:
        return None
    get = lambda name: estimator.getOrDefault(name)
    if (get("impurity") != "variance" or get("minWeightFractionPerNode") != 0 or get("leafCol") or estimator.isSet("weightCol")
            or get("featuresCol") != "features"):
        return None
    more = {}
    if kind == "tree":
        if estimator.isSet("varianceCol"):
            return None
    elif get("subsamplingRate") != 1.0:
        return None
    elif kind == "forest":
        more = {"trees": get("numTrees"), "features": get("featureSubsetStrategy"), "bootstrap": get("bootstrap") and get("numTrees") > 1}
    else:
        if get("lossType") != "squared" or estimator.isSet("validationIndicatorCol"):
            return None
        more = {"trees": get("maxIter"), "features": get("featureSubsetStrategy") if get("featureSubsetStrategy") != "auto" else "all",
                "step": get("stepSize")}
    return Spec(kind, get("maxDepth"), get("maxBins"), get("minInstancesPerNode"), get("minInfoGain"), get("seed"), **more)


# ---- cells ---------------------------------------------------------------

def thresholds(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Candidate thresholds of a feature by its distinct values in order: between all of them, or at about equal counts."""
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) <= bins - 1:
        return middle
    stride, out = counts.sum() / bins, []
    target, so_far = stride, counts[0]
    for i in range(1, len(values)):
        before, so_far = so_far, so_far + counts[i]
        if abs(before - target) < abs(so_far - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


@dataclass
class Cells:
    """Rows (id, cell, label, fold columns) stored by the code of their cell."""

    rows: DataFrame
    limits: list[np.ndarray]        # thresholds of each feature
    mean: float                     # of the label; sums are taken about it
    columns: dict[str, int]         # fold columns and their number of folds

    @property
    def sizes(self) -> list[int]:
        return [len(t) + 1 for t in self.limits]

    @property
    def strides(self) -> list[int]:
        return [int(s) for s in np.cumprod([1, *self.sizes], dtype=object)[:-1]]

    @property
    def total(self) -> int:
        return math.prod(self.sizes)


def cells(df: DataFrame, label: str, columns: Mapping[str, int], bins: int) -> Cells | None:
    """The rows of an assembled frame by cell; None where their code does not fit a number (more than 12 features of 32 bins)."""
    rows = df.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("label"),
                     *[F.col(c).cast("int").alias(f"f{i}") for i, c in enumerate(columns)])
    seen = cut_lineage(rows.select(F.posexplode("x").alias("at", "v")).groupBy("at", "v").agg(F.count(F.lit(1)).alias("n")))
    head = {r["at"]: (r["d"], r["n"]) for r in seen.groupBy("at").agg(F.count(F.lit(1)).alias("d"), F.sum("n").alias("n")).collect()}
    mean = rows.agg(F.avg("label")).first()[0]
    if not head or mean is None:
        raise ValueError("no rows to fit on")
    limits: list[np.ndarray] = [np.zeros(0)] * len(head)
    bins = min(bins, max(n for _, n in head.values()))
    few = [at for at, (d, _) in sorted(head.items(), key=lambda a: a[1][0]) if d <= VALUES // len(head)]
    many = [at for at in head if at not in few]
    got = seen.where(F.col("at").isin(few)).toPandas() if few else None         # VALUES rows at most
    for at in few:
        own = got[got["at"] == at].sort_values("v")
        limits[at] = thresholds(own["v"].to_numpy(), own["n"].to_numpy(), bins)
    for at in many:
        one = rows.select(F.get("x", F.lit(at)).alias("v"))
        cut = ordered.quantile_row(one, ["v"], [i / bins for i in range(1, bins)]).first()["q_v"]
        limits[at] = np.unique(np.array(cut, dtype=float))
    made = Cells(rows, limits, float(mean), dict(columns))
    if made.total >= 1 << 62:
        return None
    strides, names = made.strides, list(columns)

    def run(batches):
        for b in batches:
            x = b.column(0)
            x = x.flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            code = np.zeros(b.num_rows, np.int64)
            for i, (cut, stride) in enumerate(zip(limits, strides)):
                code += np.searchsorted(cut, x[:, i], side="left") * stride
            yield pa.RecordBatch.from_arrays([b.column(b.num_columns - 1), pa.array(code), *[b.column(i) for i in range(1, b.num_columns - 1)]],
                                             names=["id", "cell", "label", *[f"f{i}" for i in range(len(names))]])

    kinds = "id long, cell long, label double" + "".join(f", f{i} int" for i in range(len(names)))
    made.rows = stored(rows.withColumn("id", F.monotonically_increasing_id()).mapInArrow(run, kinds), "cells")
    return made


# ---- trees ---------------------------------------------------------------

@dataclass
class Tree:
    """Nodes by number, the root 0: feature (-1 at leaves), last bin of the left child, children, mean label."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Leaf of each cell, given by its bins (features x cells)."""
        out = np.zeros(bins.shape[1], np.int64)
        todo = [(0, np.arange(bins.shape[1]))]
        while todo:
            node, at = todo.pop()
            f = self.feature[node]
            if f < 0:
                out[at] = node
                continue
            low = bins[f, at] <= self.cut[node]
            todo += [(self.left[node], at[low]), (self.right[node], at[~low])]
        return out

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves(bins)]


def predict(parts: Sequence[tuple[float, Tree]], bins: np.ndarray) -> np.ndarray:
    """Weighted sum of trees."""
    return sum((w * t.predict(bins) for w, t in parts), np.zeros(bins.shape[1]))


@dataclass
class Growing:
    """A tree that grows: its bootstrap, training rows, the nodes of its lowest level, and what it is boosted on."""

    spec: Spec
    number: int
    column: int
    trains: np.ndarray              # whether the rows of each fold are training rows
    tree: Tree = field(default_factory=Tree)
    open: list[int] = field(default_factory=lambda: [0])
    level: int = 0
    prior: list[tuple[float, Tree]] = field(default_factory=list)

    @property
    def bag(self) -> tuple[int, int] | None:
        return (self.spec.seed, self.number) if self.spec.bootstrap else None

    def step(self, hist: np.ndarray, sizes: Sequence[int]) -> None:
        """Splits the open nodes by their histograms (nodes x bins of all features x (rows, sum of labels))."""
        t, p, following = self.tree, len(sizes), []
        ends = np.cumsum(sizes)
        for node, h in zip(self.open, hist):
            n, s = h[:ends[0]].sum(axis=0)
            if self.level == 0:
                t.value[node] = float(s / n) if n > 0 else 0.0
            best = None
            k = self.spec.some(p)
            key = [self.spec.seed & (2 ** 63 - 1), self.number, node]
            chosen = range(p) if k == p else sorted(np.random.default_rng(key).choice(p, k, replace=False).tolist())
            for f in chosen:
                part = np.cumsum(h[ends[f] - sizes[f]:ends[f]], axis=0)[:-1]
                nl, sl = part[:, 0], part[:, 1]
                nr, sr = n - nl, s - sl
                fit = (nl >= max(self.spec.least, 1)) & (nr >= max(self.spec.least, 1))
                if not fit.any():
                    continue
                both = np.where(fit, sl * sl / np.maximum(nl, 1) + sr * sr / np.maximum(nr, 1), -np.inf)
                i = int(both.argmax())
                gain = both[i] - s * s / n
                if gain > 1e-12 * abs(both[i]) and gain / n >= self.spec.gain and (best is None or gain > best[0]):
                    best = gain, f, i, sl[i] / nl[i], sr[i] / nr[i]
            if best is None:
                continue
            _, f, i, low, high = best
            a = len(t.feature)
            t.feature[node], t.cut[node], t.left[node], t.right[node] = f, i, a, a + 1
            for mean in (low, high):
                t.feature.append(-1)
                t.cut.append(0)
                t.left.append(-1)
                t.right.append(-1)
                t.value.append(float(mean))
            following += [a, a + 1]
        self.level += 1
        self.open = following if self.level < self.spec.depth else []


def _poisson_table() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Limits of the 64-bit hashes that mean 0, 1, 2, ... and, by the first 16 bits, the number and whether it is certain."""
    share, total, limits = math.exp(-1.0), 0.0, []
    for k in range(1, 21):
        total += share
        limits.append(min(int(total * 2.0 ** 64), 2 ** 64 - 1))
        share /= k
    limits = np.array(limits, dtype=np.uint64)
    low = np.arange(1 << 16, dtype=np.uint64) << np.uint64(48)
    of = np.searchsorted(limits, low, side="right")
    return limits, of.astype(np.uint8), of != np.searchsorted(limits, low | np.uint64((1 << 48) - 1), side="right")


_LIMITS, _NUMBER, _UNSURE = _poisson_table()


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bootstrap(ids: np.ndarray, bag: tuple[int, int]) -> np.ndarray:
    """How often each row is drawn for a tree: a Poisson number of mean 1 by the hash of the row's number."""
    seed = _mix(np.array([bag[0] & (2 ** 64 - 1)], np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    salt = _mix(seed + np.uint64(bag[1] + 1))
    out = np.empty(len(ids), np.uint8)
    for i in range(0, len(ids), 1 << 15):
        h = _mix(_mix(ids[i:i + (1 << 15)].view(np.uint64) + salt) + salt)
        top = (h >> np.uint64(48)).astype(np.int64)
        out[i:i + (1 << 15)] = _NUMBER[top]
        at = np.flatnonzero(_UNSURE[top])
        out[i + at] = np.searchsorted(_LIMITS, h[at], side="right")
    return out


class Block:
    """Rows of a task, or sums by cell on the driver: the bins of the cells, and sums over them."""

    def __init__(self, codes: np.ndarray, sizes: Sequence[int], strides: Sequence[int]):
        self.bins = np.stack([(codes // s) % n for s, n in zip(strides, sizes)]).astype(np.int16 if max(sizes) < 1 << 15 else np.int32)
        self.n = len(codes)

    def sums(self, bag, column: int, folds: int) -> tuple[np.ndarray, np.ndarray]:
        """(folds x cells): rows and sums of labels."""
        raise NotImplementedError


class RowBlock(Block):
    def __init__(self, made: tuple, arrays: Sequence[np.ndarray]):
        sizes, strides, total, mean = made
        self.ids, code, label, *self.folds = arrays
        if total <= GRID:
            held = np.zeros(total, dtype=bool)
            held[code] = True
            codes = np.flatnonzero(held)
            place = np.zeros(total, np.int64)
            place[codes] = np.arange(len(codes))
            self.cell = place[code]
        else:
            codes, self.cell = np.unique(code, return_inverse=True)
        super().__init__(codes, sizes, strides)
        self.label = label - mean
        self._weights = (None, None, None)

    def sums(self, bag, column, folds):
        if self._weights[1] is None or self._weights[0] != bag:
            w = bootstrap(self.ids, bag).astype(float) if bag is not None else np.ones(len(self.ids))
            self._weights = (bag, w, w * self.label)
        at = self.folds[column] * self.n + self.cell
        return tuple(np.bincount(at, v, folds * self.n).reshape(folds, self.n) for v in self._weights[1:])


class SumBlock(Block):
    def __init__(self, made: tuple, table: pd.DataFrame, folds: int):
        sizes, strides, _, _ = made
        codes, at = np.unique(table["cell"].to_numpy(), return_inverse=True)
        super().__init__(codes, sizes, strides)
        at = table["fold"].to_numpy() * self.n + at
        self.held = tuple(np.bincount(at, table[c].to_numpy(), folds * self.n).reshape(folds, self.n) for c in ("n", "s"))

    def sums(self, bag, column, folds):
        return self.held


def _histograms(block: Block, growing: Sequence[tuple[int, Growing]], sizes: Sequence[int], folds: Sequence[int], out: dict) -> None:
    """Adds the block's part to the histograms of the open nodes of each tree."""
    ends = np.cumsum(sizes)
    order = sorted(growing, key=lambda g: (g[1].bag is not None, g[1].bag or (), g[1].column))
    last = None
    for k, g in order:
        if (g.bag, g.column) != last:
            last, (rows, labels) = (g.bag, g.column), block.sums(g.bag, g.column, folds[g.column])
        n, s = rows[g.trains].sum(axis=0), labels[g.trains].sum(axis=0)
        if g.prior:
            s = 2 * (s - n * predict(g.prior, block.bins))
        slot = np.full(len(g.tree.feature), -1)
        slot[g.open] = np.arange(len(g.open))
        slot = slot[g.tree.leaves(block.bins)]
        at = np.flatnonzero((slot >= 0) & (n > 0))
        slot, n, s = slot[at], n[at], s[at]
        hist = out.setdefault(k, np.zeros((len(g.open), ends[-1], 2)))
        for f, size in enumerate(sizes):
            key = slot * size + block.bins[f, at]
            for j, v in enumerate((n, s)):
                hist[:, ends[f] - size:ends[f], j] += np.bincount(key, v, len(g.open) * size).reshape(-1, size)


def _blocks(batches, made: tuple):
    """Blocks of a task's rows."""
    kept, n = [], 0
    for b in batches:
        kept.append(b)
        n += b.num_rows
        if n >= BLOCK:
            table = pa.Table.from_batches(kept)
            yield RowBlock(made, [c.to_numpy() for c in table.columns])
            kept, n = [], 0
    if n:
        yield RowBlock(made, [c.to_numpy() for c in pa.Table.from_batches(kept).columns])


def _grow(cell: Cells, growing: Sequence[Growing]) -> None:
    """Grows the trees to their depth, a pass over the rows for each level."""
    made, sizes, folds = (cell.sizes, cell.strides, cell.total, cell.mean), cell.sizes, list(cell.columns.values())
    while True:
        now = [(k, g) for k, g in enumerate(growing) if g.open]
        if not now:
            return

        def run(batches, now=now):
            out: dict[int, np.ndarray] = {}
            for block in _blocks(batches, made):
                _histograms(block, now, sizes, folds, out)
            for k, hist in out.items():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([hist.tobytes()], pa.binary())], names=["k", "hist"])

        def merge(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(v.as_buffer()) for v in table.column("hist"))
            return pa.table({"k": table.column("k").slice(0, 1), "hist": pa.array([total.tobytes()], pa.binary())})

        parts = cell.rows.mapInArrow(run, "k int, hist binary").groupBy("k").applyInArrow(merge, "k int, hist binary")
        got = {r["k"]: np.frombuffer(bytes(r["hist"])) for r in parts.collect()}       # a histogram for each open node
        width = sum(sizes)
        for k, g in now:
            g.step(got[k].reshape(-1, width, 2) if k in got else np.zeros((len(g.open), width, 2)), sizes)


def _grow_local(block: Block, cell: Cells, g: Growing) -> None:
    while g.open:
        out: dict[int, np.ndarray] = {}
        _histograms(block, [(0, g)], cell.sizes, list(cell.columns.values()), out)
        g.step(out[0], cell.sizes)


def _sums(cell: Cells, column: int) -> pd.DataFrame | None:
    """(fold, cell, n, s): rows and sums of labels by cell, where they are few enough for the driver."""
    made, folds = (cell.sizes, cell.strides, cell.total, cell.mean), list(cell.columns.values())[column]

    def run(batches):
        strides = np.array(made[1])
        for block in _blocks(batches, made):
            n, s = block.sums(None, column, folds)
            fold, at = np.nonzero(n)
            code = (block.bins[:, at].astype(np.int64) * strides[:, None]).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(fold.astype(np.int32)), pa.array(code), pa.array(n[fold, at]), pa.array(s[fold, at])],
                                             names=["fold", "cell", "n", "s"])

    summed = cut_lineage(cell.rows.mapInArrow(run, "fold int, cell long, n double, s double").groupBy("fold", "cell")
                         .agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
    return summed.toPandas() if summed.count() <= LOCAL else None


Model = list[tuple[float, Tree]]        # trees and their weights; the label's mean is to be added


def fit(cell: Cells, fits: Sequence[tuple[Spec, str, np.ndarray]]) -> tuple[list[Model], list[float]]:
    """A model for each (settings, fold column, whether the rows of each fold are training rows), and its seconds.

    Fits that grow together share their time evenly.
    """
    names = list(cell.columns)
    models: list[Model] = [[] for _ in fits]
    seconds = [0.0] * len(fits)
    began, together = time.perf_counter(), []
    for i, (spec, column, trains) in enumerate(fits):
        if spec.kind != "boosting":
            for j in range(spec.trees):
                together.append((i, Growing(spec, j, names.index(column), trains)))
    _grow(cell, [g for _, g in together])
    alone = len({i for i, _ in together})
    for i, g in together:
        models[i].append((1.0 / fits[i][0].trees, g.tree))
    for i in {i for i, _ in together}:
        seconds[i] = (time.perf_counter() - began) / alone
    boosted = [i for i, (spec, *_) in enumerate(fits) if spec.kind == "boosting"]
    blocks: dict[str, Block | None] = {}
    for column in dict.fromkeys(fits[i][1] for i in boosted):
        table = _sums(cell, names.index(column))
        made = (cell.sizes, cell.strides, cell.total, cell.mean)
        blocks[column] = None if table is None else SumBlock(made, table, cell.columns[column])
    for i in boosted:
        spec, column, trains = fits[i]
        if blocks[column] is None:
            continue
        began = time.perf_counter()
        for j in range(spec.trees):
            g = Growing(spec, j, names.index(column), trains, prior=list(models[i]))
            _grow_local(blocks[column], cell, g)
            models[i].append((spec.step if j else 1.0, g.tree))
        seconds[i] = time.perf_counter() - began
    far = [i for i in boosted if blocks[fits[i][1]] is None]
    began = time.perf_counter()
    for j in range(max((fits[i][0].trees for i in far), default=0)):
        now = [(i, Growing(fits[i][0], j, names.index(fits[i][1]), fits[i][2], prior=list(models[i]))) for i in far if j < fits[i][0].trees]
        _grow(cell, [g for _, g in now])
        for i, g in now:
            models[i].append((fits[i][0].step if j else 1.0, g.tree))
    for i in far:
        seconds[i] = (time.perf_counter() - began) / len(far)
    return models, seconds


def errors(cell: Cells, models: Sequence[Model], of: Sequence[tuple[str, np.ndarray, np.ndarray]]) -> np.ndarray:
    """(models, 2, 5): rows, squared and absolute errors, labels and their squares (about the mean) of each model's
    training and test rows, given as (fold column, folds of training rows, folds of test rows); one pass."""
    made, names, folds = (cell.sizes, cell.strides, cell.total, cell.mean), list(cell.columns), list(cell.columns.values())
    mine = [(names.index(c), parts) for c, *parts in of]

    def run(batches):
        sums = np.zeros((len(models), 2, 5))
        for block in _blocks(batches, made):
            y = block.label
            own = [np.stack([np.bincount(block.folds[c], v, n) for v in (np.ones(len(y)), y, y * y)]) for c, n in enumerate(folds)]
            for k, (model, (c, parts)) in enumerate(zip(models, mine)):
                e = y - predict(model, block.bins)[block.cell]
                by = np.stack([np.bincount(block.folds[c], v, folds[c]) for v in (e * e, np.abs(e))])
                for j, part in enumerate(parts):
                    sums[k, j, [0, 3, 4]] += own[c][:, part].sum(axis=1)
                    sums[k, j, [1, 2]] += by[:, part].sum(axis=1)
        flat = sums.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["k", "v"])

    out = np.zeros(len(models) * 10)
    for r in cell.rows.mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        out[r["k"]] = r["v"]
    return out.reshape(-1, 2, 5)


class Fitted:
    """A fitted model that scores assembled frames."""

    def __init__(self, model: Model, limits: Sequence[np.ndarray], mean: float):
        self.model, self.limits, self.mean = model, list(limits), mean

    def transform(self, df: DataFrame) -> DataFrame:
        model, limits, mean = self.model, self.limits, self.mean

        def run(x: pd.Series) -> pd.Series:
            x = np.stack(x.to_numpy()) if len(x) else np.zeros((0, len(limits)))
            bins = np.stack([np.searchsorted(cut, x[:, i], side="left") for i, cut in enumerate(limits)])
            return pd.Series(mean + predict(model, bins))

        return df.withColumn("prediction", F.pandas_udf(run, "double")(vector_to_array("features")))


def fit_one(df: DataFrame, label: str, settings: Spec) -> Fitted | None:
    """A model on all rows of an assembled frame."""
    cell = cells(df.withColumn("__all", F.lit(0)), label, {"__all": 1}, settings.bins)
    if cell is None:
        return None
    models, _ = fit(cell, [(settings, "__all", np.array([True]))])
    return Fitted(models[0], cell.limits, cell.mean)
