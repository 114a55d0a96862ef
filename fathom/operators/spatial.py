"""Spatial statistics.

Neighbour search is a grid-bucket equi-join, never a cross join: each
point looks at the ring of cells around its own; a point whose k-th
neighbour is farther than the distance the ring is guaranteed to cover is
searched again with a wider ring, so the result is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.numeric import rnd
from fathom.operators.features import haversine_km
from fathom.session import cut_lineage


def knn(points: DataFrame, k: int = 8, tie_margin: int = 4) -> DataFrame:
    """Exact k nearest neighbours by haversine distance for points
    (id, lat, lon); ties broken by neighbour id.  Returns (id, rank,
    neighbour, distance_km).

    Great-circle distance grows with the chord between unit vectors, so the
    search is the exact grid KNN of ``neighbors.knn`` on (x, y, z): no ring
    or round cap, identical points cut to the smallest ids, busy cells split
    by finer grid levels.  ``tie_margin`` extra neighbours are fetched and
    the final order is (distance rounded to the millimetre, id), so up to
    ``tie_margin + 1`` equal distances at the k-th place resolve by id."""
    from fathom.operators.neighbors import knn as grid_knn
    la, lo = F.radians("lat"), F.radians("lon")
    unit = [(F.cos(la) * F.cos(lo)).alias("__ux"), (F.cos(la) * F.sin(lo)).alias("__uy"), F.sin(la).alias("__uz")]
    pts = points.select("id", "lat", "lon", *unit)
    ref = pts.select(F.col("id").alias("nid"), F.col("lat").alias("nlat"), F.col("lon").alias("nlon"),
                     "__ux", "__uy", "__uz")
    nb = grid_knn(pts, ref, ["__ux", "__uy", "__uz"], k + 1 + tie_margin, qid="id", rid="nid", ref_cols=["nlat", "nlon"])
    nb = nb.where(F.col("nid") != F.col("id")).join(pts.select("id", "lat", "lon"), "id")
    # distances are kept to the millimetre so ties rank the same everywhere
    nb = nb.withColumn("distance_km", rnd(haversine_km("lat", "lon", "nlat", "nlon"), 6))
    w = Window.partitionBy("id").orderBy("distance_km", "nid")
    return nb.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) \
        .select("id", "rank", F.col("nid").alias("neighbour"), "distance_km")


def spatial_lag(values: DataFrame, neighbours: DataFrame, value_col: str = "z") -> DataFrame:
    """Row-standardised KNN lag: mean of the neighbours' values."""
    v = values.select(F.col("id").alias("neighbour"), F.col(value_col).alias("__nv"))
    lag = neighbours.join(v, "neighbour").groupBy("id").agg(F.avg("__nv").alias("lag"))
    return values.join(lag, "id")


def morans_i(values: DataFrame, neighbours: DataFrame, x: str) -> DataFrame:
    """Moran's I with row-standardised KNN weights:
    I = sum z_i lag_i / sum z_i^2 with z = x - mean(x)."""
    m = values.agg(F.avg(x).alias("__m"))
    z = values.crossJoin(F.broadcast(m)).withColumn("z", F.col(x) - F.col("__m"))
    lz = spatial_lag(z, neighbours, "z")
    # I is undefined (NULL) when every z is 0
    return lz.agg(F.try_divide(F.sum(F.col("z") * F.col("lag")), F.sum(F.col("z") * F.col("z"))).alias("morans_i"),
                  F.count(F.lit(1)).alias("n"))


def local_quadrants(values: DataFrame, neighbours: DataFrame, x: str) -> DataFrame:
    """HH, LL, LH, HL by the signs of z and of its lag."""
    m = values.agg(F.avg(x).alias("__m"))
    z = values.crossJoin(F.broadcast(m)).withColumn("z", F.col(x) - F.col("__m"))
    lz = spatial_lag(z, neighbours, "z")
    q = F.when((F.col("z") > 0) & (F.col("lag") > 0), "HH").when((F.col("z") < 0) & (F.col("lag") < 0), "LL") \
        .when((F.col("z") < 0) & (F.col("lag") > 0), "LH").when((F.col("z") > 0) & (F.col("lag") < 0), "HL")
    return lz.withColumn("quadrant", q)


def moran_permutations(values: DataFrame, neighbours: DataFrame, x: str, n_perm: int = 199, seed: str = "perm") -> DataFrame:
    """G1 pseudo p-value: z values are re-assigned to points by hash rank
    per permutation (exploded), I recomputed per permutation in one job."""
    from fathom.functions.hashing import salted_h32
    from fathom.operators.ordered import row_numbers
    m = values.agg(F.avg(x).alias("__m"))
    z = values.crossJoin(F.broadcast(m)).select("id", (F.col(x) - F.col("__m")).alias("z"))
    base = row_numbers(z.withColumn("__ik", F.col("id")), ["__ik"], name="slot")
    perm = z.select("id", "z").withColumn("p", F.explode(F.sequence(F.lit(1), F.lit(n_perm))))
    perm = perm.withColumn("__h", salted_h32(F.concat(F.col("id").cast("string"), F.lit(seed), F.col("p").cast("string")), ""))
    perm = row_numbers(perm, ["__h", "id"], ["p"], name="slot")
    shuffled = perm.select("p", "slot", "z").join(base.select("slot", F.col("id").alias("pid")), "slot")
    nb = neighbours.select("id", "neighbour")
    lagged = nb.join(shuffled.select("p", F.col("pid").alias("neighbour"), F.col("z").alias("nz")), "neighbour") \
        .groupBy("p", "id").agg(F.avg("nz").alias("lag"))
    own = shuffled.select("p", F.col("pid").alias("id"), "z")
    ip = own.join(lagged, ["p", "id"]).groupBy("p").agg(F.try_divide(F.sum(F.col("z") * F.col("lag")), F.sum(F.col("z") * F.col("z"))).alias("i_perm"))
    obs = morans_i(values, neighbours, x)
    return ip.crossJoin(obs).agg(F.first("morans_i").alias("morans_i"),
                                 ((F.sum((F.col("i_perm") >= F.col("morans_i")).cast("int")) + 1) / (n_perm + 1.0)).alias("p_sim"),
                                 F.avg("i_perm").alias("mean_i_perm"))


def permutation_draws(spark, n: int, k: int, permutations: int, seed: str = "lisa", tries: int = 32) -> DataFrame:
    """(p, j, at): for each permutation k different numbers below n - 1, by
    hash: the first k different ones of ``tries`` candidates."""
    from fathom.functions.hashing import salted_h32
    c = spark.range(permutations).select((F.col("id") + 1).alias("p")).withColumn("c", F.explode(F.sequence(F.lit(1), F.lit(tries))))
    text = F.concat_ws("-", F.col("p").cast("string"), F.col("c").cast("string"))
    c = c.withColumn("at", salted_h32(text, seed) % F.lit(max(n - 1, 1)))
    first = c.groupBy("p", "at").agg(F.min("c").alias("c"))
    w = Window.partitionBy("p").orderBy("c")                    # at most ``tries`` rows
    return first.withColumn("j", F.row_number().over(w)).where(F.col("j") <= k).select("p", "j", "at")


def local_moran(values: DataFrame, neighbours: DataFrame, x: str, permutations: int = 199, seed: str = "lisa") -> DataFrame:
    """(id, quadrant, local_i, p_sim) of every point with neighbours.

    The pseudo p-value is conditional: a point keeps its value and gets k
    other points' values in each permutation.  As in common practice all
    points share the permutations' draws of k places among the n - 1 others,
    so only the values at the drawn places and the next ones (a point skips
    itself) are ever needed: 2 x permutations x k numbers, however many
    points.  They travel with the tasks; no rows x permutations table is
    made.  p = (min(m, permutations - m) + 1) / (permutations + 1), with m
    the permutations whose local I is at least the observed one.  NULL where
    fewer than k other points exist."""
    import numpy as np
    import pyarrow as pa
    from fathom.operators.ordered import row_numbers
    spark = values.sparkSession
    known = values.where(F.col(x).isNotNull())
    mean = known.agg(F.avg(x).alias("__m"))
    z = known.crossJoin(F.broadcast(mean)).select("id", (F.col(x) - F.col("__m")).alias("z"))
    placed = cut_lineage(row_numbers(z, ["id"], name="place").withColumn("place", F.col("place") - 1))
    total = placed.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("z") * F.col("z")).alias("zz")).first()
    k = neighbours.groupBy("id").agg(F.count(F.lit(1)).alias("k")).agg(F.max("k").alias("k")).first()["k"] or 0
    n = total["n"]
    drawn = permutation_draws(spark, n, k, permutations, seed)
    wanted = drawn.select("at").union(drawn.select(F.col("at") + 1)).distinct()
    there = {r["place"]: r["z"] for r in placed.join(F.broadcast(wanted), F.col("place") == F.col("at")).collect()}
    at = np.full((permutations, max(k, 1)), -1, dtype=np.int64)
    for r in drawn.collect():
        at[r["p"] - 1, r["j"] - 1] = r["at"]
    enough = k > 0 and n - 1 >= k and (at >= 0).all()
    low = np.vectorize(lambda a: there.get(a, 0.0))(at)
    high = np.vectorize(lambda a: there.get(a + 1, 0.0))(at)

    def simulate(batches):
        for batch in batches:
            place, own, lag = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("place", "z", "lag"))
            p = np.full(len(own), np.nan)
            for i in range(0, len(own) if enough else 0, 256):
                s = slice(i, i + 256)
                # a drawn place counts the others only: from the point's own place on it is the next one
                drawn_z = np.where(at[None] < place[s, None, None], low[None], high[None]).mean(axis=2)
                m = (own[s, None] * drawn_z >= (own[s] * lag[s])[:, None]).sum(axis=1)
                p[s] = (np.minimum(m, permutations - m) + 1) / (permutations + 1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("z"), batch.column("lag"), pa.array(p, from_pandas=True)],
                                             names=["id", "z", "lag", "p_sim"])

    lagged = spatial_lag(placed, neighbours, "z").select("id", "place", "z", "lag")
    kind = values.schema["id"].dataType.simpleString()
    out = lagged.mapInArrow(simulate, f"id {kind}, z double, lag double, p_sim double")
    q = F.when((F.col("z") > 0) & (F.col("lag") > 0), "HH").when((F.col("z") < 0) & (F.col("lag") < 0), "LL") \
        .when((F.col("z") < 0) & (F.col("lag") > 0), "LH").when((F.col("z") > 0) & (F.col("lag") < 0), "HL")
    scale = float(n - 1) / total["zz"] if total["zz"] else None
    return out.select("id", q.alias("quadrant"), (F.col("z") * F.col("lag") * F.lit(scale)).alias("local_i"), "p_sim")


def density_grid(df: DataFrame, lat: str, lon: str, bins: int = 120) -> DataFrame:
    """A10: counts on a bins x bins grid spanning the data range."""
    r = df.agg(F.min(lat).alias("a0"), F.max(lat).alias("a1"), F.min(lon).alias("o0"), F.max(lon).alias("o1"))
    j = df.crossJoin(F.broadcast(r))  # one row
    ci = F.least(F.floor((F.col(lat) - F.col("a0")) / (F.col("a1") - F.col("a0")) * bins).cast("int"), F.lit(bins - 1))
    cj = F.least(F.floor((F.col(lon) - F.col("o0")) / (F.col("o1") - F.col("o0")) * bins).cast("int"), F.lit(bins - 1))
    return j.groupBy(ci.alias("cell_i"), cj.alias("cell_j")).agg(F.count(F.lit(1)).alias("n"))


def grid_middles(df: DataFrame, lat: str, lon: str, bins: int = 120) -> DataFrame:
    """A10: (cell_i, cell_j, lat, lon) of the middles of a bins x bins grid
    spanning the data range."""
    r = df.agg(F.min(lat).alias("a0"), F.max(lat).alias("a1"), F.min(lon).alias("o0"), F.max(lon).alias("o1"))
    cells = df.sparkSession.range(bins * bins).crossJoin(F.broadcast(r))  # a grid of fixed size and one row
    i, j = F.floor(F.col("id") / bins).cast("int"), (F.col("id") % bins).cast("int")
    return cells.select(i.alias("cell_i"), j.alias("cell_j"),
                        (F.col("a0") + (i + 0.5) * ((F.col("a1") - F.col("a0")) / bins)).alias("lat"),
                        (F.col("o0") + (j + 0.5) * ((F.col("o1") - F.col("o0")) / bins)).alias("lon"))
