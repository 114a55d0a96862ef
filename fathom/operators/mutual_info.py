"""Mutual information by nearest neighbours (L24): how far the k-th nearest
point lies in the joint space (largest coordinate difference), and how many
points lie nearer than that in each coordinate alone.

    I = psi(n) + psi(k) - mean(psi(n_x + 1) + psi(n_y + 1))

The k-th distance comes from the grid search of ``neighbors.knn``; the counts
are sorted range counts: values and the two ends of every point's range run
through one running count per coordinate (``ordered.running_totals``), which
splits the order over tasks.  Coordinates are divided by their standard
deviation, given a small hash jitter that parts equal values, and put on a
grid of whole numbers, so that all distances and comparisons are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.functions.hashing import unit_uniform
from fathom.operators.neighbors import knn
from fathom.operators.ordered import running_totals
from fathom.session import cut_lineage

SCALE = 2.0 ** 42           # grid steps of a standard deviation; exact up to 2,048 deviations
JITTER = 1e-8               # width of the jitter, in deviations (of the mean size of the values if that is larger)


def digamma_sql(x: str) -> str:
    """psi(x) for x >= 1 as SQL text, to about 1e-10: six steps of the recurrence, then the asymptotic series."""
    y = f"({x} + 6.0e0)"
    steps = " - ".join(f"1.0e0 / ({x} + {i}.0e0)" for i in range(6))
    return (f"(ln{y} - 0.5e0 / {y} - 1.0e0 / (12.0e0 * power({y}, 2)) + 1.0e0 / (120.0e0 * power({y}, 4)) "
            f"- 1.0e0 / (252.0e0 * power({y}, 6)) + 1.0e0 / (240.0e0 * power({y}, 8)) - {steps})")


def on_grid(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, columns as whole numbers): scaled, jittered by a hash of the key and the column's name, floored."""
    stats = df.agg(*[f.alias(f"__{n}{i}") for i, c in enumerate(columns)
                     for n, f in (("s", F.stddev_pop(c)), ("m", F.avg(F.abs(F.col(c)))))])
    made = {}
    for i, c in enumerate(columns):
        s = F.when(F.col(f"__s{i}") > 0, F.col(f"__s{i}")).otherwise(F.lit(1.0))
        noise = (unit_uniform(F.concat(F.col(key).cast("string"), F.lit(f"-{c}")), "jitter") - 0.5) * JITTER
        made[c] = F.floor((F.col(c) / s + noise * F.greatest(F.lit(1.0), F.col(f"__m{i}") / s)) * F.lit(SCALE)).cast("long")
    return df.crossJoin(F.broadcast(stats)).withColumns(made).select(key, *columns)


def _nearer(points: DataFrame, axes: Sequence[str]) -> DataFrame:
    """(id, axis, near): other points whose coordinate differs by less than the point's ``r``."""
    rows = points.select("id", "r", F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).alias("v")) for a in axes])).alias("p")) \
        .select("id", "r", "p.axis", "p.v")
    # below the range: values up to v - r; up to its end: values under v + r, so that end sorts before equal values
    marks = F.explode(F.array(
        F.struct(F.col("v").alias("at"), F.lit(1).alias("turn"), F.lit(1).cast("long").alias("n"), F.lit(0).alias("sign")),
        F.struct((F.col("v") + F.col("r")).alias("at"), F.lit(0).alias("turn"), F.lit(0).cast("long").alias("n"), F.lit(1).alias("sign")),
        F.struct((F.col("v") - F.col("r")).alias("at"), F.lit(2).alias("turn"), F.lit(0).cast("long").alias("n"), F.lit(-1).alias("sign"))))
    events = rows.select("id", "axis", marks.alias("m")).select("id", "axis", "m.at", "m.turn", "m.n", "m.sign")
    run = running_totals(events, ["at", "turn"], {"__below": F.col("n")}, ["axis"])
    return run.where(F.col("sign") != 0).groupBy("id", "axis").agg((F.sum(F.col("sign") * F.col("__below")) - 1).alias("near"))


def neighbour_information(df: DataFrame, key: str, features: Sequence[str], target: str, k: int = 3) -> DataFrame:
    """(feature, n, mutual_information) of each feature with the target, at
    least 0; rows with a NULL in the feature or the target are left out of
    its row, and a feature with at most k rows left has NULL."""
    out = None
    for feature in features:
        full = df.select(F.col(key).alias("id"), F.col(feature).cast("double").alias("x"), F.col(target).cast("double").alias("y")).dropna()
        pts = cut_lineage(on_grid(full, "id", ["x", "y"]))
        far = knn(pts, pts.select(F.col("id").alias("rid"), "x", "y"), ["x", "y"], k + 1, qid="id", metric="chebyshev") \
            .where(F.col("rank") == k + 1).select("id", F.col("distance").cast("long").alias("r"))
        counts = _nearer(pts.join(far, "id"), ["x", "y"])
        n = pts.agg(F.count(F.lit(1)).alias("n"))
        mean = counts.agg(F.sum(F.expr(digamma_sql("(near + 1)"))).alias("__s"))
        both = n.crossJoin(mean)
        info = F.expr(digamma_sql("n")) + F.expr(digamma_sql(f"{k}")) - F.col("__s") / F.col("n")
        row = both.select(F.lit(feature).alias("feature"), "n", F.when(F.col("n") > k, F.greatest(info, F.lit(0.0))).alias("mutual_information"))
        out = row if out is None else out.unionByName(row)
    return out

