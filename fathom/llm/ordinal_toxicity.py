"""Toxicity by cumulative-link ordinal regression.

Grades 0..K-1 share one weight vector over sparse text features; only the
thresholds differ: P(grade <= k) = sigmoid(threshold_k - w.x), the thresholds
kept in order by writing each as the one before plus a positive step.  The
result is the expected severity, sum over k of k * P(grade = k).

Features are indicators of the lower-cased words and of their prefixes of
``PREFIXES`` bytes, hashed to ``2^BITS`` ids; those whose counts in graded and
ungraded rows differ by a G statistic of ``MIN_EVIDENCE`` or more are used.  The labels table knows only
toxic or not, so ``severity_grades`` splits the toxic rows of the sample into
two grades by how many of their words mark toxic rows (log-odds over the
sample, above or not above the median); with graded labels pass those instead.

The fit sees at most ``max_rows`` labelled rows outside the held-out fold;
scoring reads every whole text.

Defined results: null and empty texts have no features and get the prior's
severity; with labels of one class, or none, all rows get the smoothed prior;
equal texts get equal scores; extra columns are carried by ``score``.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm import labelled, textbatch
from fathom.llm.registry import query, table

MAX_ROWS = 10000
BITS = 20
PREFIXES = (4, 5)     # bytes
MIN_ROWS = 4        # sample rows that a feature needs
MIN_EVIDENCE = 20.0
PENALTY = 0.02
TOXIC_FROM = 0.5
_SIZE = 1 << BITS


def features():
    """Maker of each text's distinct feature ids."""
    stamps = labelled.Stamps(_SIZE)

    def make(texts: pa.Array):
        for w in textbatch.words(texts, plain=True):
            kinds = [((w.hash & np.uint64(_SIZE - 1)).astype(np.int64), np.concatenate([[0], np.cumsum(w.count)]))]
            for n in PREFIXES:
                long = np.flatnonzero(w.end - w.start > n)
                heads = textbatch.spans_hash(w, w.start[long], w.start[long] + n)
                kinds.append(((textbatch.mix(heads + np.uint64(n)) & np.uint64(_SIZE - 1)).astype(np.int64),
                              np.searchsorted(long, kinds[0][1])))
            for i in range(w.n_texts):
                yield stamps.distinct(np.concatenate([codes[at[i]:at[i + 1]] for codes, at in kinds]))

    return make


def _presence(rows: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    """How many of the chosen rows have each feature."""
    f = np.zeros(_SIZE)
    for i in np.flatnonzero(chosen):
        f[rows[i]] += 1
    return f


def severity_grades(rows: list[np.ndarray], toxic: np.ndarray, strong: float = 2.5) -> np.ndarray:
    """0 for rows that are not toxic, 1 or 2 for toxic rows with few or many marking features."""
    n1 = max(int(toxic.sum()), 1)
    n0 = max(len(toxic) - n1, 1)
    f1, f0 = _presence(rows, toxic > 0), _presence(rows, toxic <= 0)
    marks = (np.log((f1 + 0.5) / (n1 + 1)) - np.log((f0 + 0.5) / (n0 + 1)) > strong) & (f1 >= MIN_ROWS)
    hits = np.array([int(marks[r].sum()) for r in rows])
    middle = np.median(hits[toxic > 0]) if (toxic > 0).any() else 0
    return np.where(toxic > 0, 1 + (hits > middle), 0)


class Ordinal:
    """Cumulative-link model; parameters are the weights, the first threshold and the log steps."""

    def __init__(self, k: int, size: int):
        self.k, self.w, self.first, self.steps = k, np.zeros(size), 0.0, np.zeros(max(k - 2, 0))

    def thresholds(self) -> np.ndarray:
        return self.first + np.concatenate([[0.0], np.cumsum(np.exp(self.steps))])

    def probabilities(self, eta: np.ndarray) -> np.ndarray:
        """P(grade = k) for each row."""
        z = np.clip(self.thresholds()[None, :] - eta[:, None], -35, 35)
        below = 1 / (1 + np.exp(-z))
        full = np.hstack([np.zeros((len(eta), 1)), below, np.ones((len(eta), 1))])
        return np.maximum(np.diff(full, axis=1), 1e-12)

    def fit(self, rows: list[np.ndarray], grades: np.ndarray, penalty: float = PENALTY, steps: int = 250,
            rate: float = 0.2) -> "Ordinal":
        n, size = len(rows), len(self.w)
        ids = np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64)
        of = np.repeat(np.arange(n), [len(r) for r in rows])
        share = np.clip(np.array([(grades <= k).mean() for k in range(self.k - 1)]), 1e-3, 1 - 1e-3)
        start = np.log(share / (1 - share))
        self.first, self.steps = float(start[0]), np.log(np.maximum(np.diff(start), 1e-2))
        params = [self.w, np.array([self.first]), self.steps]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        row = np.arange(n)
        for t in range(1, steps + 1):
            eta = np.bincount(of, weights=params[0][ids], minlength=n)
            self.first, self.steps = float(params[1][0]), params[2]
            th = self.thresholds()
            z = np.clip(th[None, :] - eta[:, None], -35, 35)
            s = 1 / (1 + np.exp(-z))
            d = np.hstack([np.zeros((n, 1)), s * (1 - s), np.zeros((n, 1))])
            full = np.hstack([np.zeros((n, 1)), s, np.ones((n, 1))])
            p = np.maximum(full[row, grades + 1] - full[row, grades], 1e-12)
            up, down = d[row, grades + 1] / p, d[row, grades] / p
            g_eta = (up - down) / n                                  # of the mean negative log-likelihood
            g_th = np.zeros(self.k - 1)
            np.add.at(g_th, np.minimum(grades, self.k - 2), np.where(grades < self.k - 1, -up / n, 0))
            np.add.at(g_th, np.maximum(grades - 1, 0), np.where(grades > 0, down / n, 0))
            later = g_th[::-1].cumsum()[::-1]                        # each step moves all later thresholds
            grad = [np.bincount(ids, weights=g_eta[of], minlength=size) + penalty * params[0] / n * 10,
                    np.array([g_th.sum()]), later[1:] * np.exp(params[2])]
            for i, g in enumerate(grad):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                params[i] -= rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
        self.w, self.first, self.steps = params[0], float(params[1][0]), params[2]
        return self


def evidence(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """G statistic of each feature's presence against the class; 0 below MIN_ROWS rows."""
    n1, n0 = int(y.sum()), int((~y).sum())
    f1, f0 = _presence(rows, y), _presence(rows, ~y)
    g = np.zeros(_SIZE)
    for a, b, n in ((f1, f0, f1 + f0), (n1 - f1, n0 - f0, n1 + n0 - f1 - f0)):
        for part, whole in ((a, n1), (b, n0)):
            g += 2 * part * np.log(np.maximum(part, 1e-9) * (n1 + n0) / np.maximum(n * whole, 1e-9))
    return np.where(f1 + f0 >= MIN_ROWS, g, 0.0)


def train(rows: list[np.ndarray], labels: np.ndarray, keys: list, graded: bool = False) -> bytes:
    """Model as npz; features with too little evidence have no weight."""
    grades = labels if graded else severity_grades(rows, labels)
    k = max(int(grades.max()) + 1 if len(grades) else 2, 2)
    used = np.flatnonzero(evidence(rows, grades > 0) >= MIN_EVIDENCE)
    place = np.full(_SIZE, -1, dtype=np.int64)
    place[used] = np.arange(len(used))
    model = Ordinal(k, len(used))
    if len(np.unique(grades)) > 1:
        model.fit([place[r][place[r] >= 0] for r in rows], grades.astype(np.int64))
        thresholds = model.thresholds()
    else:
        low = np.array([(int((grades <= i).sum()) + 1) / (len(grades) + 2) for i in range(k - 1)])
        thresholds = np.log(low / (1 - low))
    w = np.zeros(_SIZE, dtype=np.float32)
    w[used] = model.w
    out = io.BytesIO()
    np.savez_compressed(out, w=w, thresholds=thresholds)
    return out.getvalue()


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS, held_out: int = 0,
        graded: bool = False) -> bytes:
    """``graded``: the label already is a grade from 0 on."""
    return labelled.fit(labelled.sample(docs, labels, label, max_rows, held_out), features,
                        lambda rows, y, keys: train(rows, y, keys, graded))


def score(df: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """df with expected_severity, p_toxic (any grade above 0) and grade (the likeliest)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def scorer():
        m = np.load(io.BytesIO(shared.value))
        w, th = m["w"].astype(np.float64), m["thresholds"]
        make = features()

        def of(texts: pa.Array):
            eta = np.fromiter((w[r].sum() for r in make(texts)), dtype=np.float64, count=len(texts))
            below = 1 / (1 + np.exp(-np.clip(th[None, :] - eta[:, None], -35, 35)))
            p = np.diff(np.hstack([np.zeros((len(eta), 1)), below, np.ones((len(eta), 1))]), axis=1)
            return [p @ np.arange(p.shape[1]), 1 - below[:, 0], p.argmax(axis=1).astype(np.int32)]

        return of

    return labelled.with_scores(df, "expected_severity double, p_toxic double, grade int", scorer, text_col)


@query("op1_ordinal_toxicity")
def op1_ordinal_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", "expected_severity", "p_toxic", "grade",
                                     (F.col("p_toxic") >= TOXIC_FROM).alias("toxic"))
