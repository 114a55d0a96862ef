"""Exact k nearest neighbours in a few Euclidean dimensions (L4 KNN
imputation, M10 KNN models).

Points are bucketed on power-of-two grids anchored at the data minimum.
Reference rows at identical coordinates are first cut to the k smallest
ids (no query can use more of them; Spark keeps only k per point in each
map task before the shuffle), and identical query points are solved once.
The search starts at the finest grid whose busiest cell holds at most
``cap`` reference rows.  Each query point looks at the 3^d block of cells
around its own and is final once it has k candidates and its k-th distance
is below the distance to the block's nearest face; the others move one
level up (cells twice as wide).  At the level whose cells are as wide as
the data, every block holds every point, so the answer is exact for all
queries without a round cap.  Pairs only come from equi-joins on cell ids,
never from a cross join.  Ties are broken by the smaller reference id.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.session import cut_lineage

LEVELS_PER_PROBE = 8


def _all(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def _finest_level(ref: DataFrame, xs: Sequence[str], lo: Sequence[float], start: int, floor_level: int,
                  cap: int) -> int:
    """Largest level <= start whose busiest cell holds <= cap rows; levels
    are probed eight at a time in one aggregate job."""
    top = start
    while top > floor_level:
        levels = list(range(top, max(top - LEVELS_PER_PROBE, floor_level), -1))
        lv = ref.select(*xs).withColumn("__lv", F.explode(F.array(*[F.lit(e) for e in levels])))
        cells = [F.floor((F.col(x) - F.lit(lo[i])) / F.pow(F.lit(2.0), F.col("__lv"))).cast("long").alias(f"__c{i}")
                 for i, x in enumerate(xs)]
        occ = lv.select("__lv", *cells).groupBy("__lv", *[f"__c{i}" for i in range(len(xs))]).count() \
            .groupBy("__lv").agg(F.max("count").alias("busiest")).collect()
        busiest = {r["__lv"]: r["busiest"] for r in occ}
        for e in levels:
            if busiest.get(e, 0) <= cap:
                return e
        top = levels[-1] - 1
    return floor_level


def knn(query: DataFrame, ref: DataFrame, features: Sequence[str], k: int, qid: str = "qid", rid: str = "rid",
        ref_cols: Sequence[str] = (), cap: int | None = None, metric: str = "euclidean") -> DataFrame:
    """(qid, rank, rid, distance, *ref_cols) for the k nearest reference rows
    of every query row whose features are all present and finite.  ``metric``
    may be "chebyshev", the largest coordinate difference."""
    feats = list(features)
    d = len(feats)
    xs = [f"__x{i}" for i in range(d)]
    cap = cap or max(64, 8 * k)
    ok_vals = _all([F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in feats])
    carry = [F.col(c).alias(f"__p_{c}") for c in ref_cols]
    r = ref.where(ok_vals & F.col(rid).isNotNull()).select(
        F.col(rid).alias("__rid"), *[F.col(c).cast("double").alias(x) for c, x in zip(feats, xs)], *carry)
    r = r.withColumn("__n", F.row_number().over(Window.partitionBy(*xs).orderBy("__rid"))) \
        .where(F.col("__n") <= k).drop("__n")
    r = cut_lineage(r)
    q = query.where(ok_vals).select(F.col(qid).alias("__qid"),
                                    *[F.col(c).cast("double").alias(x) for c, x in zip(feats, xs)])
    pts = cut_lineage(q.select(*xs).distinct())

    ext = r.select(*xs).unionByName(pts.select(*xs)).agg(
        F.count(F.lit(1)).alias("n"), *[F.min(x).alias(f"lo{i}") for i, x in enumerate(xs)],
        *[F.max(x).alias(f"hi{i}") for i, x in enumerate(xs)]).first()
    n_ref = r.count()
    if not ext["n"] or n_ref == 0:
        return query.sparkSession.createDataFrame(
            [], f"{qid} {q.schema['__qid'].dataType.simpleString()}, rank int, {rid} "
                f"{r.schema['__rid'].dataType.simpleString()}, distance double"
                + "".join(f", {c} {r.schema['__p_' + c].dataType.simpleString()}" for c in ref_cols))
    lo = [float(ext[f"lo{i}"]) for i in range(d)]
    span = max(max(float(ext[f"hi{i}"]) - lo[i] for i in range(d)), 1e-12)
    e_top = math.ceil(math.log2(span))               # cell >= span: every block holds every point
    guess = e_top - max(0, int(math.floor(math.log2(max(n_ref / k, 1.0)) / d)))  # ~k rows per cell if uniform
    e_fine = _finest_level(r, xs, lo, min(guess + 2, e_top), e_top - 60, cap)
    need = min(k, n_ref)

    offsets = list(itertools.product((-1, 0, 1), repeat=d))
    off_arr = F.array(*[F.array(*[F.lit(v) for v in o]) for o in offsets])
    apart = [F.col(x) - F.col(f"__r{i}") for i, x in enumerate(xs)]
    # a block's nearest face bounds both: no coordinate difference exceeds the distance
    if metric == "chebyshev":
        dist = F.greatest(*[F.abs(a) for a in apart]) if d > 1 else F.abs(apart[0])
    else:
        dist = F.sqrt(reduce(lambda a, b: a + b, [F.pow(a, 2) for a in apart]))
    todo = pts
    parts = []
    for e in range(e_fine, e_top + 1):
        s = 2.0 ** e
        qc = todo.select(*xs, *[F.floor((F.col(x) - F.lit(lo[i])) / F.lit(s)).cast("long").alias(f"__q{i}")
                                for i, x in enumerate(xs)])
        cand = qc.withColumn("__o", F.explode(off_arr)).select(
            *xs, *[(F.col(f"__q{i}") + F.col("__o")[i]).alias(f"__c{i}") for i in range(d)])
        rc = r.select("__rid", *[F.col(x).alias(f"__r{i}") for i, x in enumerate(xs)],
                      *[F.col(f"__p_{c}") for c in ref_cols],
                      *[F.floor((F.col(x) - F.lit(lo[i])) / F.lit(s)).cast("long").alias(f"__c{i}")
                        for i, x in enumerate(xs)])
        pairs = cand.join(rc, [f"__c{i}" for i in range(d)]).withColumn("distance", dist)
        top = pairs.withColumn("rank", F.row_number().over(Window.partitionBy(*xs).orderBy("distance", "__rid"))) \
            .where(F.col("rank") <= k).select(*xs, "rank", "__rid", "distance", *[f"__p_{c}" for c in ref_cols])
        top = cut_lineage(top)
        if e == e_top:
            parts.append(top)
            break
        # distance from the point to the nearest face of its 3^d block
        faces = [F.least(F.col(x) - F.lit(lo[i]) - (F.col(f"__q{i}") - 1) * F.lit(s),
                         (F.col(f"__q{i}") + 2) * F.lit(s) - (F.col(x) - F.lit(lo[i]))) for i, x in enumerate(xs)]
        cover = qc.select(*xs, (F.least(*faces) if d > 1 else faces[0]).alias("cover"))
        stat = top.groupBy(*xs).agg(F.max("distance").alias("kth"), F.count(F.lit(1)).alias("m"))
        fin = cut_lineage(cover.join(stat, xs).where((F.col("m") >= need) & (F.col("kth") < F.col("cover")))
                          .select(*xs))
        parts.append(top.join(fin, xs, "left_semi"))
        todo = cut_lineage(todo.join(fin, xs, "left_anti"))
        if todo.isEmpty():
            break
    res = reduce(lambda a, b: a.unionByName(b), parts)
    return q.join(res, xs).select(F.col("__qid").alias(qid), "rank", F.col("__rid").alias(rid), "distance",
                                  *[F.col(f"__p_{c}").alias(c) for c in ref_cols])


def weighted_mean(nb: DataFrame, qid: str, value: str, weights: str = "uniform") -> DataFrame:
    """Mean of the neighbours' values per query: uniform, or by inverse
    distance where neighbours at distance 0, if any, take all the weight."""
    if weights == "uniform":
        return nb.groupBy(qid).agg(F.avg(value).alias(value))
    zero = F.col("distance") == 0
    return nb.groupBy(qid).agg(
        F.when(F.count(F.when(zero, 1)) > 0, F.avg(F.when(zero, F.col(value))))
        .otherwise(F.sum(F.when(~zero, F.col(value) / F.col("distance")))
                   / F.sum(F.when(~zero, F.lit(1.0) / F.col("distance")))).alias(value))


def class_vote(nb: DataFrame, qid: str, label: str, weights: str = "distance") -> DataFrame:
    """Per query: predicted class (largest total weight, ties to the smaller
    class) and each class's weight share, for weighted KNN classification."""
    zero = F.col("distance") == 0
    has_zero = F.max(zero.cast("int")).over(Window.partitionBy(qid)) == 1
    w = F.lit(1.0) if weights == "uniform" else \
        F.when(has_zero, zero.cast("double")).otherwise(F.lit(1.0) / F.col("distance"))
    per = nb.withColumn("__w", w).groupBy(qid, label).agg(F.sum("__w").alias("__w"))
    tot = per.groupBy(qid).agg(F.sum("__w").alias("__t"),
                               F.min_by(label, F.struct((-F.col("__w")).alias("nw"), F.col(label).alias("l")))
                               .alias("prediction"))
    return per.join(tot, qid).select(qid, label, (F.col("__w") / F.col("__t")).alias("share"), "prediction")


def impute_neighbours(df: DataFrame, key: str, target: str, features: Sequence[str], k: int) -> DataFrame:
    """Donors for L4: the k nearest rows with ``target`` present for every
    row where it is NULL, carrying the donor's value."""
    miss = F.col(target).isNull()
    donors = df.where(~miss).withColumnRenamed(key, "__donor")
    return knn(df.where(miss), donors, features, k, qid=key, rid="__donor", ref_cols=[target])


def knn_impute(df: DataFrame, key: str, target: str, features: Sequence[str], k: int = 5,
               weights: str = "uniform", indicator: bool = True, nb: DataFrame | None = None) -> DataFrame:
    """L4: fill ``target`` where it is NULL from the k nearest rows (in the
    feature space) where it is present; adds ``missing_<target>``.  ``nb``
    may be a donor table from ``impute_neighbours`` with k' >= k: its first
    k ranks are the exact k nearest (same distance/id order)."""
    miss = F.col(target).isNull()
    nb = impute_neighbours(df, key, target, features, k) if nb is None else nb.where(F.col("rank") <= k)
    fill = weighted_mean(nb, key, target, weights).withColumnRenamed(target, "__fill")
    base = df.withColumn(f"missing_{target}", miss) if indicator else df
    return base.join(fill, key, "left").withColumn(target, F.coalesce(F.col(target), F.col("__fill"))).drop("__fill")
