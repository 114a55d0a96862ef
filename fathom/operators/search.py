"""Randomised search over several model families (M13): draws from parameter
distributions, cross-validated with ``crossval``, the best one refitted.

Draws come from md5 of (seed, family, draw, parameter), so a search is the
same on every cluster."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.operators import crossval, trees


def uniform(*parts) -> float:
    """A number in [0, 1) that the parts determine."""
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 16 ** 13


@dataclass(frozen=True)
class LogUniform:
    low: float
    high: float

    def at(self, u: float) -> float:
        return math.exp(math.log(self.low) + u * (math.log(self.high) - math.log(self.low)))


@dataclass(frozen=True)
class Uniform:
    low: float
    high: float

    def at(self, u: float) -> float:
        return self.low + u * (self.high - self.low)


@dataclass(frozen=True)
class IntRange:
    low: int
    high: int          # included

    def at(self, u: float) -> int:
        return self.low + int(u * (self.high - self.low + 1))


@dataclass(frozen=True)
class Choice:
    options: tuple

    def at(self, u: float):
        return self.options[int(u * len(self.options))]


@dataclass(frozen=True)
class Family:
    """A Spark ML estimator class with fixed parameters and distributions of others."""

    estimator: Callable[..., object]
    distributions: Mapping[str, object]
    fixed: Mapping[str, object]

    def draw(self, seed: str, name: str, i: int) -> dict:
        return {p: d.at(uniform(seed, name, i, p)) for p, d in sorted(self.distributions.items())}


def random_search(df: DataFrame, label: str, families: Mapping[str, Family], draws: int, scheme: crossval.Scheme,
                  seed: str = "search", parallelism: int = 4) -> tuple[DataFrame, object, str]:
    """(table, best model refitted on all rows, its candidate): ``draws``
    candidates a family, cross-validated on the scheme; the table has a row
    per candidate with its parameters and scores, place 1 the best."""
    params = {f"{name}-{i}": (name, f.draw(seed, name, i)) for name, f in families.items() for i in range(draws)}

    def builder(candidate: str):
        name, drawn = params[candidate]
        return lambda: families[name].estimator(**families[name].fixed, **drawn)

    scores = crossval.estimator_scores(df, label, {c: builder(c) for c in params}, [scheme], parallelism)
    table = crossval.candidate_table(scores)
    texts = [(c, name, ", ".join(f"{k}={v:.6g}" if isinstance(v, float) else f"{k}={v}" for k, v in drawn.items()))
             for c, (name, drawn) in params.items()]
    named = df.sparkSession.createDataFrame(texts, "learner string, family string, parameters string")
    table = table.join(F.broadcast(named), "learner")
    best = table.orderBy("place").limit(1).collect()[0]["learner"]
    chosen = builder(best)().setLabelCol(label)
    settings = trees.spec(chosen)
    model = trees.fit_one(df, label, settings) if settings is not None else None
    return table, model or chosen.fit(df), best

