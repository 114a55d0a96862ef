"""Isolation forest.

Fit: each tree draws its own sample of about ``psi`` rows by a hash test
(xxhash64 of the row key and the tree id, the key's part made once a row), so a row joins on average
2 psi / n trees and no tree's sample grows with the data; trees are grown
per tree id with ``applyInPandas`` (groups of ~2 psi rows).  Score: the
forest (trees x 2^h nodes, bounded) is broadcast and path lengths are
computed batch-wise with ``mapInPandas``, all rows of a chunk one level at a
time; the outlier cut is a quantile of the scores."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(n: float) -> float:
    """Average unsuccessful-search path length in a BST of n nodes."""
    if n <= 1:
        return 0.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(tree: int, x: np.ndarray, max_depth: int) -> list[tuple]:
    rng = np.random.default_rng(tree)
    nodes: list[tuple] = []

    def build(idx: np.ndarray, depth: int) -> int:
        nid = len(nodes)
        nodes.append(None)
        sub = x[idx]
        if depth >= max_depth or len(idx) <= 1:
            nodes[nid] = (tree, nid, -1, 0.0, -1, -1, float(len(idx)))
            return nid
        spans = sub.max(axis=0) - sub.min(axis=0)
        cand = np.flatnonzero(spans > 0)
        if cand.size == 0:
            nodes[nid] = (tree, nid, -1, 0.0, -1, -1, float(len(idx)))
            return nid
        f = int(rng.choice(cand))
        thr = float(rng.uniform(sub[:, f].min(), sub[:, f].max()))
        left = build(idx[sub[:, f] < thr], depth + 1)
        right = build(idx[sub[:, f] >= thr], depth + 1)
        nodes[nid] = (tree, nid, f, thr, left, right, float(len(idx)))
        return nid

    build(np.arange(len(x)), 0)
    return nodes


CHUNK = 4096                # rows that are drawn or scored together, so that what they need stays in the cache
_P1, _P2, _P3, _P5 = (np.uint64(v) for v in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def _hashed(seed: np.ndarray, value: int) -> np.ndarray:
    """xxHash64 of a 32-bit number from each seed: Spark's ``xxhash64(key, value)``, with ``xxhash64(key)`` as the seed."""
    v = seed + (_P5 + np.uint64(4))
    v ^= np.array([value], np.uint64) * _P1
    v = (v << np.uint64(23) | v >> np.uint64(41)) * _P2 + _P3
    v ^= v >> np.uint64(33)
    v *= _P2
    v ^= v >> np.uint64(29)
    v *= _P3
    return v ^ v >> np.uint64(32)


NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, size double"


def fit(df: DataFrame, features: Sequence[str], key: Sequence[str], n_trees: int = 100, psi: int = 256) -> DataFrame:
    feats = list(features)
    n = df.count()
    rate = min(1.0, 2.0 * psi / max(n, 1))
    cut = int(rate * 2 ** 31)
    k = F.concat_ws("-", *[F.col(c).cast("string") for c in key])
    keyed = df.select(*feats, k.alias("__k"), F.xxhash64(k).alias("__seed"))

    def draw(batches):
        for batch in batches:
            seed = batch.column(len(feats) + 1).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(seed), CHUNK):
                hits = [np.flatnonzero(_hashed(seed[i:i + CHUNK], t) & np.uint64(2 ** 31 - 1) < np.uint64(cut)) for t in range(n_trees)]
                tree = np.repeat(np.arange(n_trees, dtype=np.int32), [len(h) for h in hits])
                if len(tree):
                    rows = batch.take(pa.array(i + np.concatenate(hits)))
                    yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(tree)], names=[*feats, "__k", "tree"])

    sample = keyed.mapInArrow(draw, T.StructType([*keyed.schema.fields[:-1], T.StructField("tree", T.IntegerType())])) \
        .withColumn("__h", F.xxhash64("__k", F.col("tree")))
    max_depth = int(math.ceil(math.log2(psi)))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["__h", "__k"]).head(psi).dropna(subset=feats)
        tree = int(pdf["tree"].iloc[0]) if len(pdf) else 0
        rows = _grow(tree, pdf[feats].to_numpy(dtype=float), max_depth) if len(pdf) else []
        return pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right", "size"])

    return sample.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def score(df: DataFrame, forest: DataFrame, features: Sequence[str], psi: int = 256, out: str = "anomaly_score") -> DataFrame:
    feats = list(features)
    nodes = forest.orderBy("tree", "node").toPandas()  # bounded: trees x 2^(h+1) nodes
    trees = [_steps(g.sort_values("node")) for _, g in nodes.groupby("tree")]
    bc = df.sparkSession.sparkContext.broadcast(trees)
    cpsi = _c(psi)
    schema = T.StructType(list(df.schema.fields) + [T.StructField(out, T.DoubleType())])

    def path_lengths(batches):
        forest_ = bc.value
        for pdf in batches:
            x = pdf[feats].to_numpy(dtype=float)
            total = np.concatenate([np.zeros(0), *[_path_sums(forest_, x[i:i + CHUNK]) for i in range(0, len(x), CHUNK)]])
            pdf[out] = np.power(2.0, -(total / max(len(forest_), 1)) / cpsi)
            yield pdf

    return df.mapInPandas(path_lengths, schema)


def _steps(nodes: pd.DataFrame) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(levels, feature, threshold, next, path length) of a tree, two entries a node: node k is at 2 k, and
    ``next`` holds its left child there and its right child beside it.  A leaf is its own child."""
    feature, own = nodes["feature"].to_numpy(), np.arange(len(nodes))
    leaf = feature < 0
    left, right = (np.where(leaf, own, nodes[c].to_numpy()) for c in ("left", "right"))
    depth = np.zeros(len(nodes), np.int64)
    for i in own[~leaf]:                                    # a child comes after its parent
        depth[left[i]] = depth[right[i]] = depth[i] + 1
    length = np.where(leaf, depth + np.array([_c(v) for v in nodes["size"]]), 0.0)
    both = np.stack([left, right], axis=1).ravel() * 2
    return (int(depth.max()), *(np.repeat(v, 2) for v in (np.where(leaf, 0, feature).astype(np.int64),
                                                          nodes["threshold"].to_numpy(dtype=float))), both, np.repeat(length, 2))


def _path_sums(trees: list[tuple], x: np.ndarray) -> np.ndarray:
    """Sum of the rows' path lengths over the trees; all rows take a step at a time, those in a leaf stay there."""
    n = len(x)
    values, rows, total = np.ascontiguousarray(x.T).ravel(), np.arange(n), np.zeros(n)
    for levels, feature, threshold, after, length in trees:
        first = feature * n
        node = np.zeros(n, np.int64)
        for _ in range(levels):
            node += ~(values.take(first.take(node) + rows) < threshold.take(node))      # a NaN goes to the right
            node = after.take(node)
        total += length.take(node)
    return total
