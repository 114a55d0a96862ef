"""Cross-validated candidate tables (M15, H8, H5) over several ways of
dealing rows into folds.

Linear learners are fitted from Gram matrices: one pass over the rows gives
the matrix of every (fold column, fold), the training matrix of a split is
the sum of its folds', and a second pass scores all learners on all splits
at once, so the number of folds, repeats and learners adds no job.  Trees,
forests and boosted trees of all splits grow together (``trees``).  Other
learners are Spark ML estimators, fitted a few at a time and scored together.
All give the same long table of scores, from which ``candidate_table`` makes
the report.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.operators import trees

SCORES = ("scheme string, repeat int, fold int, learner string, part string, n long, rmse double, mae double, "
          "r2 double, fit_seconds double")


@dataclass(frozen=True)
class Scheme:
    """A way to cross-validate: columns of fold numbers 0..folds-1, one a
    repeat.  ``expanding``: fold i is scored by a model of the folds before
    it (time order); otherwise by one of all other folds.  Rows of the fold
    number ``ignored`` take no part."""

    name: str
    columns: tuple[str, ...]
    folds: int
    expanding: bool = False
    ignored: int | None = None

    def splits(self) -> list[Split]:
        return [Split(self, r, c, i) for r, c in enumerate(self.columns) for i in range(int(self.expanding), self.folds)]


@dataclass(frozen=True)
class Split:
    scheme: Scheme
    repeat: int
    column: str
    fold: int

    def trains(self, fold):
        """Whether rows (numbers, an array or a column) of a fold belong to the training rows."""
        if self.scheme.ignored is not None:
            return (fold != self.fold) & (fold != self.scheme.ignored)
        return fold < self.fold if self.scheme.expanding else fold != self.fold


@dataclass(frozen=True)
class Linear:
    """Least squares on some of the features with a ridge penalty on their
    coefficients; without features, the mean."""

    features: tuple[str, ...] = ()
    alpha: float = 0.0

    def solve(self, gram: np.ndarray, names: Sequence[str]) -> np.ndarray:
        """Coefficients of [1, *names] from the Gram matrix of [1, *names, label]."""
        at = [0, *[1 + names.index(f) for f in self.features]]
        out = np.zeros(len(names) + 1)
        n = gram[0, 0]
        if n == 0:
            return out * np.nan
        mean = gram[0, at[1:]] / n
        label = gram[0, -1] / n
        xx = gram[np.ix_(at[1:], at[1:])] - n * np.outer(mean, mean)
        xy = gram[at[1:], -1] - n * mean * label
        out[at[1:]] = np.linalg.lstsq(xx + self.alpha * np.eye(len(mean)), xy, rcond=None)[0] if len(mean) else []
        out[0] = label - mean @ out[at[1:]]
        return out


@dataclass(frozen=True)
class SparkLinear:
    """Spark's ``LinearRegression`` of squared error with an intercept, from the Gram matrix."""

    reg: float
    share: float
    standardised: bool

    @staticmethod
    def of(estimator) -> SparkLinear | None:
        """What the estimator asks for; None where it is another one, or asks for something that is not done here."""
        get = lambda name: estimator.getOrDefault(name)
        if (type(estimator) is not LinearRegression or get("loss") != "squaredError" or not get("fitIntercept")
                or estimator.isSet("weightCol") or get("solver") == "l-bfgs" or get("featuresCol") != "features"):
            return None
        return SparkLinear(get("regParam"), get("elasticNetParam"), get("standardization"))

    def solve(self, gram: np.ndarray, names: Sequence[str]) -> np.ndarray:
        from fathom.operators import penalty
        if gram[0, 0] == 0:
            return np.full(len(names) + 1, np.nan)
        if not self.standardised or self.reg == 0:
            return penalty.spark_linear(gram, self.reg, self.share)
        n, mean = gram[0, 0], gram[0, 1:-1] / gram[0, 0]
        scale = np.sqrt(np.maximum(np.diag(gram)[1:-1] / n - mean * mean, 0))
        scale[scale <= 1e-12 * np.maximum(np.abs(mean), 1)] = 1.0
        w = penalty.spark_linear(penalty.rescaled(gram, gram), self.reg, self.share)
        return np.array([w[0] - (w[1:] / scale) @ mean, *(w[1:] / scale)])


def _matrix(batch: pa.RecordBatch, p: int) -> np.ndarray:
    """Rows of [1, features, label]."""
    cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(p + 1)]
    return np.column_stack([np.ones(batch.num_rows), *cols])


def fold_grams(df: DataFrame, features: Sequence[str], label: str, columns: Mapping[str, int]) -> dict[tuple[str, int], np.ndarray]:
    """Gram matrix of [1, features, label] of each fold of each fold column
    (given with its number of folds), from one pass; rows with a NULL left out."""
    p, names = len(features), list(columns)
    width = p + 2
    starts = np.concatenate([[0], np.cumsum([columns[c] for c in names])]).astype(int)

    def run(batches):
        sums = np.zeros((starts[-1], width, width))
        for batch in batches:
            z = _matrix(batch, p)
            for c, start in enumerate(starts[:-1]):
                fold = batch.column(p + 1 + c).to_numpy(zero_copy_only=False)
                ends = np.cumsum(np.bincount(fold, minlength=columns[names[c]]))
                by_fold = z[np.argsort(fold.astype(np.uint16), kind="stable")]
                for f, end in enumerate(ends):
                    rows = by_fold[ends[f - 1] if f else 0:end]
                    sums[start + f] += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size)), pa.array(sums.ravel())], names=["k", "v"])

    rows = _numeric(df, features, label, names).mapInArrow(run, "k long, v double")
    out = np.zeros(starts[-1] * width * width)
    for r in rows.groupBy("k").agg(F.sum("v").alias("v")).collect():    # folds x (features + 2)^2 numbers
        out[r["k"]] = r["v"]
    out = out.reshape(-1, width, width)
    return {(c, f): out[starts[i] + f] for i, c in enumerate(names) for f in range(columns[c])}


def _numeric(df: DataFrame, features: Sequence[str], label: str, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate([*features, label])],
                     *[F.col(c).cast("long").alias(f"__f{i}") for i, c in enumerate(columns)]).dropna()


def training_gram(grams: Mapping[tuple[str, int], np.ndarray], split: Split) -> np.ndarray:
    return sum(g for (c, f), g in grams.items() if c == split.column and split.trains(f))


def linear_scores(df: DataFrame, features: Sequence[str], label: str, learners: Mapping[str, Linear | SparkLinear],
                  schemes: Sequence[Scheme]) -> DataFrame:
    """Scores (``SCORES``) of linear learners on every split of every scheme, in two passes over the rows."""
    features, p = list(features), len(features)
    columns = {c: max(s.folds, (s.ignored or 0) + 1) for s in schemes for c in s.columns}
    grams = fold_grams(df, features, label, columns)
    splits = [s for scheme in schemes for s in scheme.splits()]
    names = list(columns)
    betas, seconds = np.zeros((p + 1, len(splits), len(learners))), np.zeros((len(splits), len(learners)))
    for i, split in enumerate(splits):
        gram = training_gram(grams, split)
        for j, learner in enumerate(learners.values()):
            began = time.perf_counter()
            betas[:, i, j] = learner.solve(gram, features)
            seconds[i, j] = time.perf_counter() - began
    of_column = [[i for i, s in enumerate(splits) if s.column == c] for c in names]
    wide = [[i * len(learners) + j for i in mine for j in range(len(learners))] for mine in of_column]
    every = [np.arange(columns[c]) for c in names]

    def run(batches):
        sums = np.zeros((len(splits), len(learners), 2, 5))          # n, e^2, |e|, y, y^2 of training and test rows
        for batch in batches:
            z = _matrix(batch, p)
            y = z[:, -1]
            e = y[:, None] - z[:, :-1] @ betas.reshape(p + 1, -1)    # splits x learners columns
            e2, size, own = e * e, np.abs(e), np.column_stack([np.ones(len(y)), y, y * y])
            for c, mine in enumerate(of_column):
                member = (batch.column(p + 1 + c).to_numpy(zero_copy_only=False) == every[c][:, None]).astype(float)
                # sums by fold; a split's training rows are those of several folds
                n, sy, yy = (member @ own).T
                ss, sa = ((member @ v[:, wide[c]]).reshape(len(every[c]), len(mine), -1) for v in (e2, size))
                for j, i in enumerate(mine):
                    for part, in_part in enumerate((splits[i].trains(every[c]), every[c] == splits[i].fold)):
                        sums[i, :, part, 0] += n[in_part].sum()
                        sums[i, :, part, 1] += ss[in_part, j].sum(axis=0)
                        sums[i, :, part, 2] += sa[in_part, j].sum(axis=0)
                        sums[i, :, part, 3] += sy[in_part].sum()
                        sums[i, :, part, 4] += yy[in_part].sum()
        flat = sums.reshape(-1, 5)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), *[pa.array(np.ascontiguousarray(c)) for c in flat.T]],
                                         names=["k", "n", "ss", "sa", "sy", "yy"])

    sums = _numeric(df, features, label, names).mapInArrow(run, "k long, n double, ss double, sa double, sy double, yy double") \
        .groupBy("k").agg(*[F.sum(c).alias(c) for c in ("n", "ss", "sa", "sy", "yy")])
    keys = [(k, s.scheme.name, s.repeat, s.fold, name, part, float(seconds[i, j])) for k, (i, s, j, name, part) in enumerate(
        (i, s, j, name, part) for i, s in enumerate(splits) for j, name in enumerate(learners) for part in ("train", "test"))]
    named = df.sparkSession.createDataFrame(keys, "k long, scheme string, repeat int, fold int, learner string, part string, fit_seconds double")
    spread = F.col("yy") - F.col("sy") * F.col("sy") / F.col("n")
    return sums.where("n > 0").join(F.broadcast(named), "k").select(
        "scheme", "repeat", "fold", "learner", "part", F.col("n").cast("long").alias("n"),
        F.sqrt(F.col("ss") / F.col("n")).alias("rmse"), (F.col("sa") / F.col("n")).alias("mae"),
        F.when(spread > 0, 1 - F.col("ss") / spread).alias("r2"), "fit_seconds")


def errors(prediction: str = "prediction", label: str = "label") -> list[Column]:
    """n, rmse, mae and r2 of scored rows as aggregates."""
    e = F.col(label) - F.col(prediction)
    return [F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
            (1 - F.try_divide(F.sum(e * e), F.var_pop(label) * F.count(F.lit(1)))).alias("r2")]


def estimator_scores(df: DataFrame, label: str, learners: Mapping[str, Callable[[], object]], schemes: Sequence[Scheme],
                     parallelism: int = 4) -> DataFrame:
    """Scores (``SCORES``) of Spark ML estimators on an assembled frame.

    Linear regressions are fitted from Gram matrices and trees, forests and
    boosted trees by ``trees``, all of them together; of the others each fit
    is a job of its own, ``parallelism`` of them at a time.  All models of a
    kind are scored on their training and test rows in one pass."""
    made = {name: builder() for name, builder in learners.items()}
    linear = {name: SparkLinear.of(e) for name, e in made.items()}
    grown = {name: trees.spec(e) for name, e in made.items()}
    linear, grown = ({name: s for name, s in specs.items() if s is not None} for specs in (linear, grown))
    out = []
    if linear:
        columns = list(dict.fromkeys(c for s in schemes for c in s.columns))
        p = len(df.select("features").first()[0])
        names = [f"__x_{i}" for i in range(p)]
        flat = df.select(label, *columns, vector_to_array("features").alias("__x")) \
            .select(label, *columns, *[F.get("__x", F.lit(i)).alias(n) for i, n in enumerate(names)])
        out.append(linear_scores(flat, names, label, linear, schemes))
    for bins in sorted({s.bins for s in grown.values()}):
        mine = {name: s for name, s in grown.items() if s.bins == bins}
        scores = tree_scores(df, label, mine, schemes)
        if scores is None:
            grown = {name: s for name, s in grown.items() if name not in mine}
        else:
            out.append(scores)
    rest = {name: b for name, b in learners.items() if name not in linear and name not in grown}
    if rest:
        out.append(_fit_scores(df, label, rest, schemes, parallelism))
    scores = out[0]
    for more in out[1:]:
        scores = scores.unionByName(more)
    return scores


def tree_scores(df: DataFrame, label: str, learners: Mapping[str, trees.Spec], schemes: Sequence[Scheme]) -> DataFrame | None:
    """Scores (``SCORES``) of tree learners of one number of bins, all grown together; None where their cells have no code."""
    columns = {c: max(s.folds, (s.ignored or 0) + 1) for s in schemes for c in s.columns}
    cell = trees.cells(df, label, columns, next(iter(learners.values())).bins)
    if cell is None:
        return None
    jobs = [(s, name) for scheme in schemes for s in scheme.splits() for name in learners]
    every = {c: np.arange(n) for c, n in columns.items()}
    models, seconds = trees.fit(cell, [(learners[name], s.column, s.trains(every[s.column])) for s, name in jobs])
    sums = trees.errors(cell, models, [(s.column, s.trains(every[s.column]), every[s.column] == s.fold) for s, _ in jobs])
    found = []
    for (s, name), t, both in zip(jobs, seconds, sums):
        for part, (n, ss, sa, sy, yy) in zip(("train", "test"), both.tolist()):
            if n:
                spread = yy - sy * sy / n
                found.append((s.scheme.name, s.repeat, s.fold, name, part, int(n), (ss / n) ** 0.5, sa / n,
                              1 - ss / spread if spread > 0 else None, t))
    return df.sparkSession.createDataFrame(found, SCORES)


def _fit_scores(df: DataFrame, label: str, learners: Mapping[str, Callable[[], object]], schemes: Sequence[Scheme],
                parallelism: int) -> DataFrame:
    def fitted(job):
        split, name = job
        estimator = learners[name]().setLabelCol(label)
        began = time.perf_counter()
        model = estimator.fit(df.where(split.trains(F.col(split.column))))
        return model, time.perf_counter() - began

    jobs = [(s, name) for scheme in schemes for s in scheme.splits() for name in learners]
    with ThreadPool(max(1, min(parallelism, len(jobs)))) as pool:
        fits = list(pool.imap(fitted, jobs))
    rows, each = df, []
    for k, ((split, _), (model, _)) in enumerate(zip(jobs, fits)):
        rows = model.setPredictionCol(f"__p{k}").transform(rows)
        fold = F.col(split.column)
        part = F.when(fold == split.fold, "test").when(split.trains(fold), "train")
        each.append(F.struct(F.lit(k).alias("k"), part.alias("part"), F.col(f"__p{k}").alias("prediction")))
    scored = rows.select(label, F.explode(F.array(*each)).alias("__s")).where("__s.part IS NOT NULL") \
        .select(label, "__s.*").groupBy("k", "part").agg(*errors(label=label)).collect()         # two rows a fit
    found = [(s.scheme.name, s.repeat, s.fold, name, r["part"], r["n"], r["rmse"], r["mae"], r["r2"], fits[r["k"]][1])
             for r in scored for s, name in [jobs[r["k"]]]]
    return df.sparkSession.createDataFrame(found, SCORES)


def candidate_table(scores: DataFrame) -> DataFrame:
    """Per scheme and learner, mean and spread over the splits of the
    test scores, mean training scores, the gap between them and the mean fit
    time; ``place`` 1 is the least test RMSE of the scheme."""
    test, train = F.col("part") == "test", F.col("part") == "train"
    t = scores.groupBy("scheme", "learner").agg(
        F.count(F.when(test, 1)).alias("n_splits"),
        F.avg(F.when(test, F.col("rmse"))).alias("cv_rmse"), F.stddev_pop(F.when(test, F.col("rmse"))).alias("cv_rmse_std"),
        F.avg(F.when(train, F.col("rmse"))).alias("train_rmse"), F.avg(F.when(test, F.col("mae"))).alias("cv_mae"),
        F.avg(F.when(train, F.col("mae"))).alias("train_mae"), F.avg(F.when(test, F.col("r2"))).alias("cv_r2"),
        F.avg(F.when(train, F.col("r2"))).alias("train_r2"), F.avg(F.when(test, F.col("fit_seconds"))).alias("fit_seconds"))
    w = Window.partitionBy("scheme").orderBy("cv_rmse", "learner")   # a few learners
    return t.withColumn("gap", F.col("cv_rmse") - F.col("train_rmse")).withColumn("place", F.row_number().over(w))


def scheme_inflation(table: DataFrame, reference: str) -> DataFrame:
    """H8: how much lower each learner's test RMSE is under the reference
    scheme than under each other one (positive: the reference flatters it)."""
    base = table.where(F.col("scheme") == reference).select("learner", F.col("cv_rmse").alias("__base"))
    return table.where(F.col("scheme") != reference).join(F.broadcast(base), "learner") \
        .select("scheme", "learner", (F.try_divide(F.col("cv_rmse"), F.col("__base")) - 1).alias("inflation"))
