"""Gaussian kernel density without a cut-off.

Coordinates are taken in bandwidths.  Points to score are put in blocks of a
fixed grid, reference points in a tree of bundles, each level twice as fine; a
bundle is 8 x 8 cells.  Pairs of a block and a bundle are followed down the
tree as rows of a table, and a pair is let go when

* its nearest distance D says that every term in it is below ``eta / n`` of
  the largest term of the sum, whose distance the tree bounds from above:
  D^2 > bound^2 + 2 ln(n / eta); or
* the bundle has at most ``RAW`` points, or its cells are small enough for
  their expansions, which replace the points of a cell: with c the cell's
  centre, u a point's offset from it and k = x - c,

      sum over u of exp(-|k - u|^2 / 2)
          = exp(-|k|^2 / 2) sum over u of exp(-|u|^2 / 2) exp(k.u),

  where exp(k.u) is a Taylor polynomial of order p in k.u, so that the cell's
  points count by their moments up to order p.  The error of a term is at most
  t^(p+1) / (p+1)! e^t of the term itself, t the largest |k.u|; p is the
  smallest order that makes it ``eta``.

Of a cell's expansion only as much is needed as its share of the sum asks for:
its terms may have the relative error ``eta`` times (a bound of the whole sum
from below) / (a bound of the cell's terms from above).  Where many points to
score lie together, the sums are made at ``m x m`` Chebyshev nodes of their box
and interpolated, after a factor exp(s^2 / 2) that leaves a sum of exp(s.v), s
the offset from the middle, v that of a reference point; m is the smallest of
``NODES`` whose error, summed over the cells, is below ``eta``.

A cell of at most ``RAW`` points travels as its points, a fuller one as its
moments, which take no more room than ``RAW`` points.  A bundle goes once to
each block that needs it; there the points are taken by a finer grid, whose
cells leave out again what is too far for them.

All terms are positive, so the relative error of every density, however small,
is at most 2 ``eta``.  Sums are kept as logarithms: no density is zero and none
is undefined unless there are no reference points.  The pairs are bounded by
the area in bandwidths, not by the number of points, and what travels by the
points and the area.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.session import cut_lineage

ETA = 1e-11
ORDERS = (2, 4, 6, 8, 10, 12, 14, 16, 20, 24)
NODES = (8, 12, 16, 20, 24, 28)     # Chebyshev nodes along a side of a box of targets
PAYS = 2.5                          # points to score for each node along a side from which on nodes are quicker
AMPLIFIED = 40.0                    # what interpolation can make of an error at the nodes: 3.1^2 (Lebesgue) x LEVEL
LEVEL = 4.0                         # largest ratio of the values at the nodes that is interpolated
SIDE = 16.0 / 3.0                   # of the target blocks and of level 0 of the tree, in bandwidths
CELLS = 8                           # cells of a bundle along a side
PARTS = 4                           # groups of a block's targets along a side
RAW = 160                           # points of a cell that are kept as such: about the room of its moments
FEW = 20                            # points up to which a term each is quicker than the moments
AT_ONCE = 131072                    # target points of one block that a task takes together
BUSY = 200_000                      # points of one bundle that a task takes together
_HALF = math.sqrt(0.5)              # half the diagonal of a unit cell


def _largest(order: int, eta: float) -> float:
    """Largest t for which the polynomial of the order is within eta."""
    low, high = 0.0, 50.0
    for _ in range(200):
        t = (low + high) / 2
        error = (order + 1) * math.log(t) - math.lgamma(order + 2) + t if t > 0 else -math.inf
        low, high = (t, high) if error <= math.log(eta) else (low, t)
    return low


def _cell(x: str, side: float) -> Column:
    return F.floor(F.col(x) / F.lit(side)).cast("long")


def _boxes(level: int) -> tuple[Column, Column]:
    """Squared nearest and farthest distance of a target cell (tx, ty) and a tree cell (cx, cy)."""
    side, near, far = SIDE * 2.0 ** level, F.lit(0.0), F.lit(0.0)
    for t, c in (("tx", "cx"), ("ty", "cy")):
        t0, c0 = F.col(t) * F.lit(SIDE), F.col(c) * F.lit(side)
        gap = F.greatest(F.lit(0.0), c0 - (t0 + SIDE), t0 - (c0 + side))
        reach = F.greatest(c0 + side - t0, t0 + SIDE - c0)
        near, far = near + gap * gap, far + reach * reach
    return near, far


def _tree_level(ref: DataFrame, base: DataFrame, level: int) -> DataFrame:
    """Occupied bundles (g, cx, cy, held) of a level with their numbers of points."""
    if level >= 0:
        at = [F.shiftright(c, level).alias(c) for c in ("cx", "cy")]
        return base.groupBy("g", *at).agg(F.sum("held").alias("held"))
    side = SIDE * 2.0 ** level
    return ref.groupBy("g", _cell("x", side).alias("cx"), _cell("y", side).alias("cy")).agg(F.count(F.lit(1)).alias("held"))


def _cell_pairs(targets: DataFrame, ref: DataFrame, n: int, eta: float) -> list[tuple[int, DataFrame]]:
    """(level, pairs (g, tx, ty, cx, cy)) of target blocks and the reference bundles that count for them."""
    spread = 2 * math.log(max(n, 2) / eta)
    widest = _largest(ORDERS[-1], eta)
    base = cut_lineage(ref.groupBy("g", _cell("x", SIDE).alias("cx"), _cell("y", SIDE).alias("cy"))
                       .agg(F.count(F.lit(1)).alias("held")))
    ends = base.select("cx", "cy").unionByName(targets.select(F.col("tx").alias("cx"), F.col("ty").alias("cy"))).agg(
        *[f(c).alias(f"{f.__name__}_{c}") for c in ("cx", "cy") for f in (F.min, F.max)]).first()
    span = max(ends["max_cx"] - ends["min_cx"], ends["max_cy"] - ends["min_cy"], 1) + 1
    level = max(span - 1, 1).bit_length()
    level += level % 2
    # at the top at most four cells of a group cover the data
    open_ = targets.join(F.broadcast(_tree_level(ref, base, level)), "g")
    out = []
    while True:
        near, far = _boxes(level)
        bound = F.min("__far").over(Window.partitionBy("g", "tx", "ty"))
        half = _HALF * SIDE * 2.0 ** level / CELLS
        reach = F.sqrt(F.col("__bound") + spread) + 2 * _HALF * SIDE / PARTS + half
        small = reach * half <= widest
        if level < 0:
            small = small | (F.col("held") <= RAW)
        kept = open_.withColumn("__near", near).withColumn("__far", far).withColumn("__bound", bound) \
            .where(F.col("__near") <= F.col("__bound") + spread) \
            .select("g", "tx", "ty", "cx", "cy", small.alias("__small"))
        kept = cut_lineage(kept)
        state = kept.agg(F.max("__small").alias("any"), F.min("__small").alias("all")).first()
        if state["any"]:
            out.append((level, kept.where("__small").drop("__small")))
        if state["any"] is None or state["all"]:
            return out
        step = 2 if level >= 2 else 1
        level -= step
        below = _tree_level(ref, base, level).select("g", F.shiftright("cx", step).alias("px"), F.shiftright("cy", step).alias("py"),
                                                     F.col("cx").alias("__cx"), F.col("cy").alias("__cy"), "held")
        open_ = kept.where("NOT __small").withColumnsRenamed({"cx": "px", "cy": "py"}).join(below, ["g", "px", "py"]) \
            .select("g", "tx", "ty", F.col("__cx").alias("cx"), F.col("__cy").alias("cy"), "held")


_P = ORDERS[-1]
_KEPT = np.add.outer(np.arange(_P + 1), np.arange(_P + 1)) <= _P      # exponents (a, b) of the moments
_SIZE = int(_KEPT.sum())
_FACT = np.array([1.0 / math.factorial(i) for i in range(_P + 1)])
_WEIGHT = np.outer(_FACT, _FACT) * _KEPT
_BUNDLE = "g long, level long, cx long, cy long, cells binary, held binary"


def _moments(u: np.ndarray, v: np.ndarray, side: float) -> np.ndarray:
    """Scaled moments, (order + 1) x (order + 1), of points at offsets (u, v) from their cell's centre, in sides."""
    up, vp = np.empty((_P + 1, len(u))), np.empty((_P + 1, len(u)))
    up[0], vp[0] = np.exp(-0.5 * side * side * (u * u + v * v)), 1.0
    for i in range(_P):
        up[i + 1], vp[i + 1] = up[i] * u, vp[i] * v
    return (up @ vp.T) * _WEIGHT


def _middle(c: int, sub: int, side: float) -> float:
    return (c * CELLS + sub + 0.5) * side


def _held(points: np.ndarray, more: np.ndarray | None, key: tuple) -> np.ndarray:
    """What a cell travels as: its points (x, y) one after the other, or their moments with those already summed."""
    if more is None and len(points) <= RAW:
        return points.ravel()
    level, cx, cy, sub = key[1:]
    side = SIDE * 2.0 ** level / CELLS
    total = np.zeros(_SIZE) if more is None else more
    for i in range(0, len(points), 8192):
        p = points[i:i + 8192]
        total = total + _moments((p[:, 0] - _middle(cx, sub // CELLS, side)) / side,
                                 (p[:, 1] - _middle(cy, sub % CELLS, side)) / side, side)[_KEPT]
    return total


def _bundle_rows(cells: Iterator[tuple[tuple, int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """One row a bundle, from its cells ((g, level, cx, cy, sub), points, held) in order of their keys."""
    names = ["g", "level", "cx", "cy", "cells", "held"]
    rows, heads, held, last = [], [], [], None

    def packed(key):
        return (*key, np.array(heads, dtype=np.int64).tobytes(), np.concatenate(held).tobytes())

    def record():
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64() if i < 4 else pa.binary()) for i in range(6)],
                                          names=names)
    for key, n, values in cells:
        if key[:4] != last:
            if heads:
                rows.append(packed(last))
                if len(rows) == 64:
                    yield record()
                    rows = []
            heads, held, last = [], [], key[:4]
        heads.append((key[4], n))
        held.append(values)
    if heads:
        rows.append(packed(last))
        yield record()


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bundles of a partition's points (g, level, cx, cy, x, y)."""
    table = pa.Table.from_batches(list(batches)) if batches else None
    if table is None or not table.num_rows:
        return
    g, level, cx, cy, x, y = (table.column(i).to_numpy() for i in range(6))
    side = SIDE * np.exp2(level.astype(float)) / CELLS
    sub = (np.floor(x / side).astype(np.int64) - cx * CELLS) * CELLS + np.floor(y / side).astype(np.int64) - cy * CELLS
    order = np.lexsort((sub, cy, cx, level, g))
    keys, points = np.column_stack([g, level, cx, cy, sub])[order], np.column_stack([x, y])[order]
    starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])

    def cells():
        for key, i, j in zip(map(tuple, keys[starts[:-1]].tolist()), starts[:-1].tolist(), starts[1:].tolist()):
            yield key, j - i, _held(points[i:j], None, key)
    yield from _bundle_rows(cells())


def _parts(cells: bytes, held: bytes) -> Iterator[tuple[int, int, np.ndarray]]:
    """(sub, points, held) of each cell of a bundle."""
    values, at = np.frombuffer(held), 0
    for sub, n in np.frombuffer(cells, dtype=np.int64).reshape(-1, 2).tolist():
        size = 2 * n if n <= RAW else _SIZE
        yield sub, n, values[at:at + size]
        at += size


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bundles whose points were dealt to several tasks, put together."""
    raw: dict[tuple, list[np.ndarray]] = {}
    sums: dict[tuple, np.ndarray] = {}
    count: dict[tuple, int] = {}
    for batch in batches:
        for *key, cells, held in zip(*(batch.column(i).to_pylist() for i in range(6))):
            for sub, n, values in _parts(cells, held):
                k = (*key, sub)
                count[k] = count.get(k, 0) + n
                if n > RAW:
                    sums[k] = sums[k] + values if k in sums else values
                else:
                    raw.setdefault(k, []).append(values.reshape(-1, 2))
    none = np.zeros((0, 2))
    yield from _bundle_rows((k, count[k], _held(np.concatenate(raw.get(k, [none])), sums.get(k), k)) for k in sorted(count))


def _bundles(ref: DataFrame, listed: DataFrame, levels: list[int]) -> DataFrame:
    """(g, level, cx, cy, cells, held): the bundles of the levels that are listed."""
    rows = None
    for level in levels:
        side = SIDE * 2.0 ** level
        one = ref.select("g", F.lit(level).cast("long").alias("level"), _cell("x", side).alias("cx"), _cell("y", side).alias("cy"), "x", "y")
        rows = one if rows is None else rows.unionByName(one)
    keys = ["g", "level", "cx", "cy"]
    if len(levels) > 1:
        rows = rows.join(listed.select(*keys).distinct(), keys, "left_semi")
    busiest = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    if busiest <= BUSY:
        return rows.repartition(*keys).mapInArrow(_build, _BUNDLE)
    salt = F.pmod(F.xxhash64("x", "y"), F.lit(-(-busiest // BUSY)))
    return rows.repartition(*keys, salt).mapInArrow(_build, _BUNDLE).repartition(*keys).mapInArrow(_merge, _BUNDLE)


def _expand(kx: np.ndarray, ky: np.ndarray, m: np.ndarray, side: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The expansions but for exp(-k^2 / 2): offsets (points x cells) from the centres, moments (cells x (P + 1) x (P + 1))."""
    sums = np.empty(kx.shape)
    for p in ORDERS:
        mine = np.flatnonzero(order == p)
        step = max(1, (1 << 18) // (len(kx) * (p + 1)))
        for i in range(0, len(mine), step):
            at = mine[i:i + step]
            powers = []
            for k in (kx, ky):
                t = (k[:, at] * side[at]).T
                out = np.empty((len(at), len(t[0]), p + 1))
                out[:, :, 0] = 1.0
                for a in range(p):
                    np.multiply(out[:, :, a], t, out=out[:, :, a + 1])
                powers.append(out)
            few = m[at][:, :p + 1, :p + 1] * _KEPT[_P - p:, :p + 1]            # a + b at most p
            sums[:, at] = np.einsum("cta,cta->ct", np.matmul(powers[0], few), powers[1]).T
    return sums


def _log_sum(values: np.ndarray) -> float:
    top = values.max()
    return float(top + np.log(np.exp(values - top).sum()))


_ORDER, _ORDER_FACT = np.array(ORDERS), np.array([math.lgamma(p + 2) for p in ORDERS])


def _smallest_order(t: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Index in ORDERS of the smallest order whose logarithmic relative error at t is within room; their number if none is."""
    with np.errstate(divide="ignore"):
        error = (_ORDER + 1) * np.log(t)[:, None] - _ORDER_FACT + t[:, None]
    return np.where((error <= room[:, None]).any(axis=1), (error <= room[:, None]).argmax(axis=1), len(ORDERS))


def _chebyshev(m: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes in -1..1 and their barycentric weights."""
    angle = (2 * np.arange(m) + 1) * (math.pi / (2 * m))
    return np.cos(angle), np.where(np.arange(m) % 2, -1.0, 1.0) * np.sin(angle)


def _shares(z: np.ndarray, m: int) -> np.ndarray:
    """(points x m): what the value at each node counts for at the points z in -1..1."""
    nodes, weights = _chebyshev(m)
    gap = z[:, None] - nodes
    hit = gap == 0
    out = weights / np.where(hit, 1.0, gap)
    out /= out.sum(axis=1)[:, None]
    on = hit.any(axis=1)
    out[on] = hit[on]
    return out


class _Cells:
    """The cells of a block's bundles."""

    def __init__(self, bundles: pa.Table, points: int):
        heads, values = [], []
        for level, cx, cy, cells, held in zip(*(bundles.column(c).to_pylist() for c in ("level", "cx", "cy", "cells", "held"))):
            h = np.frombuffer(cells, dtype=np.int64).reshape(-1, 2)
            heads.append(np.column_stack([np.full(len(h), SIDE * 2.0 ** level / CELLS), cx * CELLS + h[:, 0] // CELLS,
                                          cy * CELLS + h[:, 0] % CELLS, h[:, 1]]))
            values.append(np.frombuffer(held))
        heads, self.values = np.concatenate(heads), np.concatenate(values)
        self.side, self.n = heads[:, 0], heads[:, 3].astype(np.int64)
        self.low = heads[:, 1:3] * self.side[:, None]
        self.mid, self.half, self.log_n = self.low + self.side[:, None] / 2, _HALF * self.side, np.log(self.n)
        size = np.where(self.n <= RAW, 2 * self.n, _SIZE)
        self.start = np.cumsum(size) - size
        self.full = self.n > (FEW if points > 64 else RAW)          # cells with moments, made here where they pay
        self.slot = np.cumsum(self.full) - 1
        self.moments = np.zeros((int(self.full.sum()), _P + 1, _P + 1))
        for i in np.flatnonzero(self.n > RAW).tolist():
            self.moments[self.slot[i]][_KEPT] = self.values[self.start[i]:self.start[i] + size[i]]
        made = np.flatnonzero(self.full & (self.n <= RAW))
        for i in range(0, len(made), 256):
            self._make(made[i:i + 256])

    def _make(self, cells: np.ndarray) -> None:
        """Moments of cells that travel as points, the powers of all their points at once."""
        n, at = self.n[cells], self._points(cells)
        side = np.repeat(self.side[cells], n)
        ends = np.cumsum(n)
        powers = np.empty((2, _P + 1, ends[-1]))
        u, v = ((self.values[at + i] - np.repeat(self.mid[cells, i], n)) / side for i in range(2))
        powers[0, 0], powers[1, 0] = np.exp(-0.5 * side * side * (u * u + v * v)), 1.0
        for a in range(_P):
            powers[0, a + 1], powers[1, a + 1] = powers[0, a] * u, powers[1, a] * v
        for slot, start, end in zip(self.slot[cells].tolist(), (ends - n).tolist(), ends.tolist()):
            np.matmul(powers[0, :, start:end], powers[1, :, start:end].T, out=self.moments[slot])
        self.moments[self.slot[cells]] *= _WEIGHT

    def _points(self, cells: np.ndarray) -> np.ndarray:
        """Where in the values the points of the cells are."""
        n = self.n[cells]
        return np.repeat(self.start[cells], n) + 2 * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))

    def near(self, box: np.ndarray) -> np.ndarray:
        """Squared distance of each cell from a box ((x0, x1), (y0, y1))."""
        return np.square(np.maximum(0.0, np.maximum(self.low - box[:, 1], box[:, 0] - self.low - self.side[:, None]))).sum(axis=1)

    def least(self, box: np.ndarray) -> float:
        """What the logarithm of the sum is at least everywhere in a box."""
        far = np.square(np.maximum(self.low + self.side[:, None] - box[:, 0], box[:, 1] - self.low)).sum(axis=1)
        return _log_sum(self.log_n - far / 2)

    def room(self, box: np.ndarray, eta: float) -> np.ndarray:
        """Logarithm of the relative error that each cell's terms may have; cells of log(1 / 2) or more are left out.

        These hold eta / 2 of the sum together, errors of the others are eta / 2 of it.
        """
        return self.least(box) - (self.log_n - self.near(box) / 2) + math.log(eta / 4 / len(self.n))

    def _taken(self, box: np.ndarray, eta: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Points (x, y) that count by themselves in a box, cells that count by expansions and their orders."""
        room = self.room(box, eta)
        kept = np.flatnonzero(room < math.log(0.5))
        dense, rest = kept[self.full[kept]], kept[~self.full[kept]]
        apart = np.sqrt(np.square(np.maximum(np.abs(self.mid[dense] - box[:, 0]), np.abs(self.mid[dense] - box[:, 1]))).sum(axis=1))
        p = _smallest_order(apart * self.half[dense], np.maximum(room[dense], math.log(eta / 4)))
        expand = (p < len(ORDERS)) | (self.n[dense] > RAW)
        at = self._points(np.concatenate([rest, dense[~expand]]))
        return self.values[at], self.values[at + 1], dense[expand], _ORDER[np.minimum(p[expand], len(ORDERS) - 1)]

    def log_sums(self, x: np.ndarray, y: np.ndarray, box: np.ndarray, eta: float) -> np.ndarray:
        """Logarithms of the kernel sums at points of a box, each within eta of itself."""
        rx, ry, dense, orders = self._taken(box, eta)
        m = self.moments[self.slot[dense]]
        step = max(64, (1 << 19) // max(len(rx) + len(dense), 1))             # keeps the arrays at some MB
        out = np.empty(len(x))
        for i in range(0, len(x), step):
            px, py = x[i:i + step, None], y[i:i + step, None]
            logs = np.empty((len(px), len(rx) + len(dense)))
            for j in range(0, len(rx), 1 << 14):
                k = slice(j, min(j + (1 << 14), len(rx)))
                logs[:, k] = -0.5 * (np.square(px - rx[k]) + np.square(py - ry[k]))
            if len(dense):
                kx, ky = px - self.mid[dense, 0], py - self.mid[dense, 1]
                logs[:, len(rx):] = -0.5 * (kx * kx + ky * ky)
            top = logs.max(axis=1)
            terms = np.exp(logs - top[:, None])
            if len(dense):
                terms[:, len(rx):] *= _expand(kx, ky, m, self.side[dense], orders)
            out[i:i + step] = top + np.log(terms.sum(axis=1))
        return out

    def grid_sums(self, x: np.ndarray, y: np.ndarray, box: np.ndarray, eta: float) -> np.ndarray:
        """As ``log_sums`` at all (x, y) of a grid in a box: exp(-d^2 / 2) is a product, so sums are products of matrices."""
        rx, ry, dense, orders = self._taken(box, eta)
        total = np.zeros((len(x), len(y)))
        for i in range(0, len(rx), 1 << 13):
            k = slice(i, i + (1 << 13))
            total += np.exp(-0.5 * np.square(x[:, None] - rx[k])) @ np.exp(-0.5 * np.square(y[:, None] - ry[k])).T
        for p in ORDERS:
            mine = dense[orders == p]
            step = max(1, (1 << 16) // (len(x) * (p + 1)))
            for i in range(0, len(mine), step):
                at = mine[i:i + step]
                powers = []
                for j, z in enumerate((x, y)):
                    k = z[None, :] - self.mid[at, j, None]
                    out = np.empty((len(at), len(z), p + 1))
                    out[:, :, 0] = np.exp(-0.5 * k * k)
                    k *= self.side[at, None]
                    for a in range(p):
                        np.multiply(out[:, :, a], k, out=out[:, :, a + 1])
                    powers.append(out)
                few = self.moments[self.slot[at], :p + 1, :p + 1] * _KEPT[_P - p:, :p + 1]
                left, right = (c.transpose(1, 0, 2).reshape(len(x), -1) for c in (np.matmul(powers[0], few), powers[1]))
                total += left @ right.T
        return np.log(total)

    def nodes(self, box: np.ndarray, points: int, eta: float) -> int:
        """Nodes along a side with which interpolation in the box is within eta; 0 where it doesn't pay for the points."""
        if PAYS * NODES[0] > points or self.least(box) < -300:               # no factor of a term underflows
            return 0
        middle, reach = box.mean(axis=1), (box[:, 1] - box[:, 0]) / 2
        kept = self.room(box, eta / AMPLIFIED) < math.log(0.5)
        a = (np.abs(self.mid - middle) + self.side[:, None] / 2)[kept] * reach + 1e-300
        weight = (self.log_n - self.near(np.column_stack([middle, middle])) / 2)[kept]
        most = self.least(box) + math.log(eta)
        for m in NODES:
            if PAYS * m > points:
                return 0
            if (a > m + 1).any():
                continue
            # twice the Chebyshev coefficients of exp(a z) from the m-th on, 2 I_k(a) each
            error = math.log(8) + m * np.log(a / 2) - math.lgamma(m + 1) + np.square(a / 2) / (m + 1)
            if _log_sum(weight + np.logaddexp(error[:, 0] + a[:, 1], error[:, 1] + a[:, 0] + math.log(3.1))) <= most:
                return m
        return 0

    def interpolated(self, x: np.ndarray, y: np.ndarray, box: np.ndarray, m: int, eta: float) -> np.ndarray | None:
        """Logarithms of the kernel sums from those at m x m nodes of the box; None where these differ too much."""
        middle, reach = box.mean(axis=1), np.maximum((box[:, 1] - box[:, 0]) / 2, 1e-9)
        z = _chebyshev(m)[0]
        u, v = z * reach[0], z * reach[1]
        ends = np.column_stack([middle - reach, middle + reach])
        sums = self.grid_sums(middle[0] + u, middle[1] + v, ends, eta) + (u[:, None] ** 2 + v ** 2) / 2
        if sums.max() - sums.min() > math.log(LEVEL):
            return None
        values, out = np.exp(sums - sums.max()), np.empty(len(x))
        for i in range(0, len(x), 1 << 14):
            k = slice(i, i + (1 << 14))
            u, v = x[k] - middle[0], y[k] - middle[1]
            got = np.einsum("ia,ia->i", _shares(u / reach[0], m) @ values, _shares(v / reach[1], m))
            out[k] = sums.max() + np.log(got) - (u * u + v * v) / 2
        return out


def _evaluate(x: np.ndarray, y: np.ndarray, bundles: pa.Table, eta: float) -> np.ndarray:
    """Logarithms of the kernel sums at the points of a block over its bundles."""
    cells = _Cells(bundles, len(x))
    part = np.floor(x / (SIDE / PARTS)).astype(np.int64), np.floor(y / (SIDE / PARTS)).astype(np.int64)
    order = np.lexsort(part)
    edges = np.flatnonzero((np.diff(part[0][order]) != 0) | (np.diff(part[1][order]) != 0)) + 1
    out = np.empty(len(x))
    for group in np.split(order, edges):
        gx, gy = x[group], y[group]
        box = np.array([[c.min(), c.max()] for c in (gx, gy)])
        m = cells.nodes(box, len(group), eta / 2)
        got = cells.interpolated(gx, gy, box, m, eta / 2 / AMPLIFIED) if m else None
        out[group] = cells.log_sums(gx, gy, box, eta) if got is None else got
    return out


def log_kernel_sums(points: DataFrame, ref: DataFrame, eta: float = ETA) -> DataFrame:
    """(g, x, y, log_sum) for the distinct points (g, x, y): the logarithm of
    the sum of exp(-d^2 / 2) over the reference points (g, x, y) of the same
    group g (a long).  Relative error of the sum at most 2 ``eta``.  A point
    whose group has no reference points has no row."""
    points = cut_lineage(points.select("g", "x", "y").dropna().distinct()
                         .withColumns({"tx": _cell("x", SIDE), "ty": _cell("y", SIDE)}))
    ref = cut_lineage(ref.select("g", "x", "y").dropna())
    schema = "g long, x double, y double, log_sum double"
    n = ref.groupBy("g").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"]
    sizes = points.groupBy("g", "tx", "ty").agg(F.count(F.lit(1)).alias("__size"))
    cells = cut_lineage(sizes.select("g", "tx", "ty", F.ceil(F.col("__size") / AT_ONCE).cast("int").alias("salts")))
    pairs = _cell_pairs(cells.drop("salts"), ref, n, eta / AMPLIFIED) if n and not cells.isEmpty() else []
    if not pairs:
        return points.sparkSession.createDataFrame([], schema)
    listed = None
    for level, frame in pairs:
        one = frame.select("g", "tx", "ty", F.lit(level).cast("long").alias("level"), "cx", "cy")
        listed = one if listed is None else listed.unionByName(one)
    lists = listed.join(cells, ["g", "tx", "ty"]).join(_bundles(ref, listed, [level for level, _ in pairs]), ["g", "level", "cx", "cy"]) \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    asked = points.join(cells, ["g", "tx", "ty"]).withColumn("salt", F.pmod(F.xxhash64("x", "y"), F.col("salts")).cast("int"))

    def evaluate(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"g": pa.array([], pa.int64()), **{c: pa.array([], pa.float64()) for c in ("x", "y", "log_sum")}})
        x, y = left.column("x").to_numpy(), left.column("y").to_numpy()
        return pa.table({"g": left.column("g"), "x": left.column("x"), "y": left.column("y"),
                         "log_sum": _evaluate(x, y, right, eta)})

    keys = ["g", "tx", "ty", "salt"]
    other = lists.select(*[F.col(k).alias(f"__{k}") for k in keys], "level", "cx", "cy", "cells", "held")
    return asked.groupBy(*keys).cogroup(other.groupBy(*[f"__{k}" for k in keys])).applyInArrow(evaluate, schema)


def log_density(points: DataFrame, ref: DataFrame, bandwidth: float, eta: float = ETA) -> DataFrame:
    """(id, log_density) of each point (id, lat, lon) under the Gaussian
    kernel of the reference points (lat, lon), distances in the coordinate
    plane.  NULL for a point without coordinates, and for all if there are no
    reference points."""
    scaled = [(F.col(c) / F.lit(float(bandwidth))).alias(a) for c, a in (("lat", "x"), ("lon", "y"))]
    pts = points.select("id", F.lit(0).cast("long").alias("g"), *scaled)
    base = ref.select(F.lit(0).cast("long").alias("g"), *scaled)
    n = base.dropna().agg(F.count(F.lit(1)).alias("__n"))
    sums = log_kernel_sums(pts, base, eta)
    norm = F.log(F.col("__n") * F.lit(2 * math.pi * bandwidth * bandwidth))
    return pts.join(sums, ["g", "x", "y"], "left").crossJoin(F.broadcast(n)) \
        .select("id", (F.col("log_sum") - F.when(F.col("__n") > 0, norm)).alias("log_density"))


def bandwidth_scores(points: DataFrame, bandwidths: list[float], fold: str = "fold", folds: int = 3,
                     eta: float = ETA) -> DataFrame:
    """(bandwidth, mean_log_likelihood, n_scored): mean log density of
    each point (lat, lon, fold) under the points of the other folds, for every
    bandwidth, all (bandwidth, fold) models in one job."""
    pts = points.select("lat", "lon", fold).dropna()
    table = pts.withColumn("__b", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(h)).alias("h"))
                                                       for i, h in enumerate(bandwidths)])))
    x, y = (F.col("lat") / F.col("__b.h")).alias("x"), (F.col("lon") / F.col("__b.h")).alias("y")
    group = lambda f: (F.col("__b.i") * folds + f).cast("long").alias("g")
    asked = table.select(group(F.col(fold)), x, y)
    known = table.withColumn("__f", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).where(F.col("__f") != F.col(fold)) \
        .select(group(F.col("__f")), x, y)
    sizes = known.groupBy("g").agg(F.count(F.lit(1)).alias("__n"))          # folds x bandwidths rows
    h = F.get(F.array(*[F.lit(float(b)) for b in bandwidths]), (F.col("g") / folds).cast("int"))
    scored = asked.join(log_kernel_sums(asked, known, eta), ["g", "x", "y"]).join(F.broadcast(sizes), "g") \
        .select(h.alias("bandwidth"), (F.col("log_sum") - F.log(F.col("__n") * F.lit(2 * math.pi) * h * h)).alias("ll"))
    return scored.groupBy("bandwidth").agg(F.avg("ll").alias("mean_log_likelihood"), F.count("ll").alias("n_scored"))
