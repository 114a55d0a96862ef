"""Quality classifier: naive Bayes support vectors (NBSVM).

Features are indicators of byte n-grams (1 to 3 bytes, case kept), of pairs of
neighbouring word lengths and of repetition (which share of the words equals
the word one, two or three places before, and which share is distinct).  Each indicator is scaled by its class log-count ratio; a linear model
with hinge loss is fitted to the scaled, length-normalised rows by dual
coordinate descent, one dual variable per row; its margins are turned into
probabilities by a sigmoid fitted on rows left out of a second fit.

The fit sees at most ``max_rows`` labelled rows outside the held-out fold
(chosen by a hash of the id); scoring reads every whole text.

Defined results: null and empty texts have only the constant feature and get
its score; labels null are not used; with one class or no labelled rows the
score is the smoothed share of class 1; extra columns are carried by
``score``; equal texts get equal scores.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm import labelled, textbatch
from fathom.llm.registry import query, table

MAX_ROWS = 8000
BITS = 18
THRESHOLD = 0.3
HELD_OUT = 0
_TWO, _THREE, _WORDS = 256, 256 + 65536, 256 + 65536 + (1 << 17)
_SIZE = 1 << BITS


def features(orders: int = 3):
    """Maker of each text's distinct feature ids; id 0 is the constant."""
    stamps = labelled.Stamps(_SIZE)

    def make(texts: pa.Array):
        for w in textbatch.words(texts, lower=False):
            d = w.data.astype(np.int64)
            one = d
            two = _TWO + (d[:-1] << 8 | d[1:]) if orders > 1 else d[:0]
            tri = ((d[:-2] << 16 | d[1:-1] << 8 | d[2:]) * 0x9E3779B1 >> 15 & 0xFFFF) if len(d) > 2 else d[:0]
            tri = _THREE + (tri << 1 | (d[:-2] & 1)) if len(d) > 2 else tri
            length = np.minimum(w.end - w.start, 31)
            ends = np.concatenate([[0], np.cumsum(w.count)])
            h = w.hash
            for i in range(w.n_texts):
                a, b = int(w.bounds[i]), int(w.bounds[i + 1])
                p, q = int(ends[i]), int(ends[i + 1])
                codes = [np.zeros(1, np.int64), one[a:b], two[a:max(a, b - 1)], tri[a:max(a, b - 2)]]
                n = q - p
                if n:
                    own, size = h[p:q], length[p:q]
                    same = [np.count_nonzero(own[k:] == own[:-k]) * 16 // n for k in (1, 2, 3) if k < n]
                    fresh = len(np.unique(own)) * 16 // n
                    codes.append(_WORDS + np.array([*(64 * k + min(s, 15) for k, s in enumerate(same)),
                                                    256 + fresh * 16 + min(n.bit_length(), 15)]))
                    codes.append(_WORDS + 1024 + (size[:-1] << 5 | size[1:]))
                yield stamps.distinct(np.concatenate(codes))

    return make


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, alpha: float = 1.0, size: int = _SIZE) -> np.ndarray:
    out = []
    for c in (1, 0):
        f = np.full(size, alpha)
        for r in (r for r, v in zip(rows, y) if v == c):
            f[r] += 1
        out.append(np.log(f / f.sum()))
    return out[0] - out[1]


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float = 1.0,
                            epochs: int = 30, tol: float = 0.02, seed: int = 7) -> np.ndarray:
    """Weights of the hinge-loss model over the scaled rows; the constant feature stays unscaled."""
    scale = ratio.copy()
    scale[0] = 1.0
    norm = np.array([max(float(np.sqrt((scale[r] ** 2).sum())), 1e-12) for r in rows])
    w, dual, sign = np.zeros(len(ratio)), np.zeros(len(rows)), np.where(y > 0, 1.0, -1.0)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            idx = rows[i]
            v = scale[idx] / norm[i]
            g = sign[i] * float(w[idx] @ v) - 1.0
            a = dual[i]
            step = min(max(a - g, 0.0), cost) - a
            if step:
                dual[i] = a + step
                w[idx] += step * sign[i] * v
                worst = max(worst, abs(step))
        if worst < tol:
            break
    return w * scale


def margins(rows: list[np.ndarray], w: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    scale = ratio.copy()
    scale[0] = 1.0
    return np.array([w[r].sum() / max(float(np.sqrt((scale[r] ** 2).sum())), 1e-12) for r in rows])


def sigmoid_fit(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's sigmoid: slope and offset by Newton steps on smoothed targets."""
    n1, n0 = int((y > 0).sum()), int((y <= 0).sum())
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, float(np.log((n1 + 1) / (n0 + 1)))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -35, 35)))
        g, v = p - t, np.maximum(p * (1 - p), 1e-9)
        ga, gb = g @ m + 1e-3 * a, g.sum()
        haa, hab, hbb = v @ (m * m) + 1e-3, v @ m, v.sum() + 1e-9
        det = haa * hbb - hab * hab
        if det <= 0:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - float(np.clip(da, -5, 5)), b - float(np.clip(db, -5, 5))
        if abs(da) + abs(db) < 1e-8:
            break
    return a, b


def train(rows: list[np.ndarray], y: np.ndarray, keys: list) -> bytes:
    """Model as npz: weights, squared scales, slope, offset, and the share of class 1."""
    share = (int((y > 0).sum()) + 1) / (len(y) + 2)
    w, scale, a, b = np.zeros(_SIZE), np.ones(_SIZE), 0.0, float(np.log(share / (1 - share)))
    if 0 < (y > 0).sum() < len(y):
        left_out = np.arange(len(y)) % 4 == 3
        fitted = [i for i in range(len(y)) if not left_out[i]]
        part_y = y[fitted]
        if 0 < (part_y > 0).sum() < len(part_y) and left_out.any():
            part = [rows[i] for i in fitted]
            r = log_count_ratios(part, part_y)
            m = margins([rows[i] for i in np.flatnonzero(left_out)], dual_coordinate_descent(part, part_y, r), r)
            a, b = sigmoid_fit(m, y[left_out])
        else:
            a, b = 4.0, 0.0
        r = log_count_ratios(rows, y)
        w, scale = dual_coordinate_descent(rows, y, r), r
    scale = scale.copy()
    scale[0] = 1.0
    out = io.BytesIO()
    np.savez(out, w=w.astype(np.float32), s=(scale ** 2).astype(np.float32), ab=np.array([a, b]))
    return out.getvalue()


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS,
        held_out: int = HELD_OUT) -> bytes:
    return labelled.fit(labelled.sample(docs, labels, label, max_rows, held_out), features, train)


def score(df: DataFrame, model: bytes, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """df with the probability of label 1 for each whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def scorer():
        m = np.load(io.BytesIO(shared.value))
        w, s, (a, b) = m["w"].astype(np.float64), m["s"].astype(np.float64), m["ab"]
        make = features()

        def of(texts: pa.Array):
            z = np.fromiter((w[r].sum() / max(float(np.sqrt(s[r].sum())), 1e-12) for r in make(texts)),
                            dtype=np.float64, count=len(texts))
            return [1 / (1 + np.exp(-np.clip(a * z + b, -35, 35)))]

        return of

    return labelled.with_scores(df, f"{score_col} double", scorer, text_col)


@query("op4_quality_nbsvm")
def op4_quality_nbsvm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", F.coalesce(labelled.fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
