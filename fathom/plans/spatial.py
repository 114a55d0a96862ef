"""Spatial queries (J4, J5, G1-G3, G5, L18, A10) on supplier and customer
points placed by a fixed formula of their keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions.hashing import sql_bucket, sql_key_text, sql_salted_h32
from fathom.functions.numeric import rnd, sql_rnd
from fathom.operators import gwr, kde
from fathom.operators import spatial as G
from fathom.operators.features import haversine_km
from fathom.plans.common import coords, sql_coords
from fathom.plans.features import HUBS
from fathom.plans.registry import query
from fathom.sources.tables import Tables

K = 8
LAT_S, LON_S = sql_coords("s_suppkey")
LAT_C, LON_C = sql_coords("c_custkey")


def supplier_points(spark, sf_dir):
    lat, lon = coords("s_suppkey")
    s = Tables(spark, sf_dir).supplier
    return s.select(F.col("s_suppkey").alias("id"), lat.alias("lat"), lon.alias("lon"), "s_acctbal", "s_nationkey")


def _hav(a_lat, a_lon, b_lat, b_lon):
    return (f"(2 * 6371.0e0 * asin(sqrt(power(sin(radians({b_lat} - {a_lat}) / 2), 2) + "
            f"cos(radians({a_lat})) * cos(radians({b_lat})) * power(sin(radians({b_lon} - {a_lon}) / 2), 2))))")


SQL_KNN = f"""p AS (SELECT s_suppkey AS id, {LAT_S} AS lat, {LON_S} AS lon, s_acctbal, s_nationkey FROM supplier),
d AS (SELECT a.id, b.id AS neighbour, round({_hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} * 1e6) / 1e6 AS distance_km
      FROM p a JOIN p b ON a.id <> b.id),
kn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance_km, neighbour) AS rank FROM d)
       WHERE rank <= {K})"""


@query("knn_neighbours", ["J4"], sql=f"""
WITH {SQL_KNN}
SELECT id, CAST(rank AS INTEGER) AS rank, neighbour, distance_km FROM kn
""")
def knn_neighbours(spark, sf_dir):
    nb = G.knn(supplier_points(spark, sf_dir), K)
    return nb.select("id", F.col("rank").cast("int").alias("rank"), "neighbour", "distance_km")


SQL_Z = """mu AS (SELECT avg(s_acctbal) AS m FROM p),
z AS (SELECT id, s_acctbal - m AS z FROM p CROSS JOIN mu),
lg AS (SELECT kn.id, avg(z.z) AS lag FROM kn JOIN z ON kn.neighbour = z.id GROUP BY kn.id)"""


@query("morans_i", ["G1", "J4"], sql=f"""
WITH {SQL_KNN}, {SQL_Z}
SELECT {sql_rnd('sum(z * lag) / sum(z * z)', 8)} AS morans_i, count(*) AS n FROM z JOIN lg USING (id)
""")
def morans_i(spark, sf_dir):
    pts = supplier_points(spark, sf_dir)
    m = G.morans_i(pts, G.knn(pts, K), "s_acctbal")
    return m.select(rnd("morans_i", 8).alias("morans_i"), "n")


@query("local_moran_quadrants", ["G2"], sql=f"""
WITH {SQL_KNN}, {SQL_Z}
SELECT CASE WHEN z > 0 AND lag > 0 THEN 'HH' WHEN z < 0 AND lag < 0 THEN 'LL' WHEN z < 0 AND lag > 0 THEN 'LH'
            WHEN z > 0 AND lag < 0 THEN 'HL' END AS quadrant, count(*) AS n FROM z JOIN lg USING (id) GROUP BY 1
""")
def local_moran_quadrants(spark, sf_dir):
    pts = supplier_points(spark, sf_dir)
    q = G.local_quadrants(pts, G.knn(pts, K), "s_acctbal")
    return q.groupBy("quadrant").agg(F.count(F.lit(1)).alias("n"))


PERMUTATIONS, TRIES = 199, 32
_SWAP = sql_salted_h32("concat_ws('-', CAST(p AS VARCHAR), CAST(c AS VARCHAR))", "lisa")


@query("local_moran_significance", ["G2"], sql=f"""
WITH {SQL_KNN}, {SQL_Z},
o AS (SELECT id, z, row_number() OVER (ORDER BY id) - 1 AS place, count(*) OVER () AS n FROM z),
dc AS (SELECT p, c, {_SWAP} % (SELECT any_value(n) - 1 FROM o) AS spot FROM range(1, {PERMUTATIONS + 1}) AS a(p), range(1, {TRIES + 1}) AS b(c)),
dd AS (SELECT p, spot, min(c) AS c FROM dc GROUP BY p, spot),
dr AS (SELECT p, spot FROM dd QUALIFY row_number() OVER (PARTITION BY p ORDER BY c) <= {K}),
si AS (SELECT o.id, p, o.z * avg(v.z) AS i FROM o CROSS JOIN dr JOIN o v ON v.place = CASE WHEN dr.spot < o.place THEN dr.spot ELSE dr.spot + 1 END
       GROUP BY o.id, o.z, p),
mm AS (SELECT si.id, any_value(o.z) AS z, any_value(lag) AS lag, any_value(n) AS n, count(*) FILTER (WHERE i >= o.z * lag) AS m
       FROM si JOIN o USING (id) JOIN lg USING (id) GROUP BY si.id)
SELECT id, CASE WHEN z > 0 AND lag > 0 THEN 'HH' WHEN z < 0 AND lag < 0 THEN 'LL' WHEN z < 0 AND lag > 0 THEN 'LH'
                WHEN z > 0 AND lag < 0 THEN 'HL' END AS quadrant, {sql_rnd('z * lag * (n - 1) / (SELECT sum(z * z) FROM o)', 8)} AS local_i,
       (least(m, {PERMUTATIONS} - m) + 1) / {PERMUTATIONS + 1}.0e0 AS p_sim,
       (least(m, {PERMUTATIONS} - m) + 1) / {PERMUTATIONS + 1}.0e0 < 0.05e0 AS significant FROM mm
""")
def local_moran_significance(spark, sf_dir):
    """Local Moran's I of every supplier with its quadrant and conditional pseudo p-value."""
    pts = supplier_points(spark, sf_dir)
    lm = G.local_moran(pts, G.knn(pts, K), "s_acctbal", PERMUTATIONS)
    return lm.select("id", "quadrant", rnd("local_i", 8).alias("local_i"), "p_sim", (F.col("p_sim") < 0.05).alias("significant"))


@query("residual_morans_i", ["G3"], sql=f"""
WITH {SQL_KNN},
r AS (SELECT id, s_acctbal - avg(s_acctbal) OVER (PARTITION BY s_nationkey) AS resid FROM p),
mu AS (SELECT avg(resid) AS m FROM r),
z AS (SELECT id, resid - m AS z FROM r CROSS JOIN mu),
lg AS (SELECT kn.id, avg(z.z) AS lag FROM kn JOIN z ON kn.neighbour = z.id GROUP BY kn.id)
SELECT {sql_rnd('sum(z * lag) / sum(z * z)', 8)} AS morans_i, count(*) AS n FROM z JOIN lg USING (id)
""")
def residual_morans_i(spark, sf_dir):
    pts = supplier_points(spark, sf_dir)
    nat = pts.groupBy("s_nationkey").agg(F.avg("s_acctbal").alias("__nm"))
    res = pts.join(nat, "s_nationkey").withColumn("resid", F.col("s_acctbal") - F.col("__nm"))
    m = G.morans_i(res, G.knn(pts, K), "resid")
    return m.select(rnd("morans_i", 8).alias("morans_i"), "n")


@query("moran_permutation_test", ["G1"])
def moran_permutation_test(spark, sf_dir):
    pts = supplier_points(spark, sf_dir)
    return G.moran_permutations(pts, G.knn(pts, K), "s_acctbal", 199)


@query("centre_r2", ["G5", "J5", "X17"], sql="""
WITH c AS (SELECT c_acctbal, """ + LAT_C + " AS lat, " + LON_C + """ AS lon FROM customer)
""" + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS centre, {sql_rnd('regr_r2(c_acctbal, ' + _hav('lat', 'lon', repr(a) + 'e0', repr(o) + 'e0') + ')', 8)} AS r2 FROM c"
    for n, a, o in HUBS))
def centre_r2(spark, sf_dir):
    lat, lon = coords("c_custkey")
    c = Tables(spark, sf_dir).customer.select("c_acctbal", lat.alias("lat"), lon.alias("lon"))
    hubs = spark.createDataFrame([(n, float(a), float(o)) for n, a, o in HUBS], "centre string, hlat double, hlon double")
    j = c.crossJoin(F.broadcast(hubs))  # point-to-centre: a fixed handful of centres
    d = j.withColumn("d", haversine_km("lat", "lon", "hlat", "hlon"))
    return d.groupBy("centre").agg(rnd(F.expr("regr_r2(c_acctbal, d)"), 8).alias("r2"))


@query("density_grid", ["A10"], sql=f"""
WITH c AS (SELECT {LAT_C} AS lat, {LON_C} AS lon FROM customer),
r AS (SELECT min(lat) AS a0, max(lat) AS a1, min(lon) AS o0, max(lon) AS o1 FROM c)
SELECT least(CAST(floor((lat - a0) / (a1 - a0) * 120) AS INTEGER), 119) AS cell_i,
       least(CAST(floor((lon - o0) / (o1 - o0) * 120) AS INTEGER), 119) AS cell_j, count(*) AS n
FROM c CROSS JOIN r GROUP BY ALL
""")
def density_grid(spark, sf_dir):
    lat, lon = coords("c_custkey")
    c = Tables(spark, sf_dir).customer.select(lat.alias("lat"), lon.alias("lon"))
    return G.density_grid(c, "lat", "lon", 120)


BW = 5.0


SQL_SOURCES = f"""
c AS (SELECT c_custkey AS id, {LAT_C} AS lat, {LON_C} AS lon FROM customer),
s AS (SELECT {LAT_S} AS lat, {LON_S} AS lon FROM supplier),
n AS (SELECT count(*) AS n FROM s)"""


def _sql_log_sum(h2, a="c", b="s"):
    """Logarithm of a sum of kernels, taken out of the largest term so that none underflows."""
    e = f"(-(power({a}.lat - {b}.lat, 2) + power({a}.lon - {b}.lon, 2)) / (2 * {h2}))"
    return f"max({e}) + ln(sum(exp({e} - mx)))", e


_LOG_SUM, _TERM = _sql_log_sum(f"{BW * BW}e0")


@query("kde_log_density", ["L18"], sql=f"""
WITH {SQL_SOURCES},
m AS (SELECT c.id, any_value(c.lat) AS lat, any_value(c.lon) AS lon, max({_TERM}) AS mx FROM c CROSS JOIN s GROUP BY c.id),
k AS (SELECT c.id, {_LOG_SUM} AS ls FROM m AS c CROSS JOIN s GROUP BY c.id)
SELECT id, {sql_rnd(f'ls - ln(n * 2 * pi() * {BW * BW}e0)', 6)} AS log_density FROM k CROSS JOIN n
""")
def kde_log_density(spark, sf_dir):
    """Log density of every customer point under the kernel of all supplier points, however far."""
    lat, lon = coords("c_custkey")
    c = Tables(spark, sf_dir).customer.select(F.col("c_custkey").alias("id"), lat.alias("lat"), lon.alias("lon"))
    k = kde.log_density(c, supplier_points(spark, sf_dir).select("lat", "lon"), BW)
    return k.select("id", rnd("log_density", 6).alias("log_density"))


@query("density_surface", ["A10", "L18"], sql=f"""
WITH {SQL_SOURCES},
r AS (SELECT min(lat) AS a0, max(lat) AS a1, min(lon) AS o0, max(lon) AS o1 FROM s),
g AS (SELECT CAST(i.x AS INTEGER) AS cell_i, CAST(j.x AS INTEGER) AS cell_j, a0 + (i.x + 0.5e0) * ((a1 - a0) / 120) AS lat,
             o0 + (j.x + 0.5e0) * ((o1 - o0) / 120) AS lon FROM range(120) AS i(x), range(120) AS j(x), r),
m AS (SELECT cell_i, cell_j, any_value(c.lat) AS lat, any_value(c.lon) AS lon, max({_TERM}) AS mx FROM g AS c CROSS JOIN s GROUP BY ALL),
k AS (SELECT cell_i, cell_j, {_LOG_SUM} AS ls FROM m AS c CROSS JOIN s GROUP BY ALL)
SELECT cell_i, cell_j, {sql_rnd(f'ls - ln(n * 2 * pi() * {BW * BW}e0)', 6)} AS log_density FROM k CROSS JOIN n
""")
def density_surface(spark, sf_dir):
    """Log density of the supplier points at the middles of a 120 x 120 grid over their range."""
    pts = supplier_points(spark, sf_dir).select("lat", "lon")
    grid = G.grid_middles(pts, "lat", "lon", 120).withColumn("id", F.col("cell_i") * 120 + F.col("cell_j"))
    k = kde.log_density(grid, pts, BW)
    return k.select((F.col("id") / 120).cast("int").alias("cell_i"), (F.col("id") % 120).cast("int").alias("cell_j"),
                    rnd("log_density", 6).alias("log_density"))


BANDWIDTHS = (1.0, 2.0, 5.0, 10.0, 20.0, 40.0)
_LS_CV, _TERM_CV = _sql_log_sum("h * h", "a", "b")


@query("kde_bandwidth_cv", ["L19", "L18"], sql=f"""
WITH c AS (SELECT c_custkey AS id, {LAT_C} AS lat, {LON_C} AS lon, {sql_bucket(sql_key_text("c_custkey"), "kde", 3)} AS fold FROM customer),
h AS (SELECT unnest([{", ".join(f"{b}e0" for b in BANDWIDTHS)}]) AS h),
n AS (SELECT f.fold, count(*) AS n FROM (SELECT DISTINCT fold FROM c) f JOIN c ON c.fold <> f.fold GROUP BY 1),
m AS (SELECT h, a.id, any_value(a.lat) AS lat, any_value(a.lon) AS lon, any_value(a.fold) AS fold, max({_TERM_CV}) AS mx
      FROM c AS a JOIN c AS b ON a.fold <> b.fold CROSS JOIN h GROUP BY h, a.id),
k AS (SELECT h, a.id, any_value(a.fold) AS fold, {_LS_CV} AS ls FROM m AS a JOIN c AS b ON a.fold <> b.fold GROUP BY h, a.id)
SELECT h AS bandwidth, {sql_rnd('avg(ls - ln(n * 2 * pi() * h * h))', 6)} AS mean_log_likelihood, count(*) AS n_scored
FROM k JOIN n USING (fold) GROUP BY h
""")
def kde_bandwidth_cv(spark, sf_dir):
    """Mean held-out log density of customer points under a KDE of the other
    folds, for six bandwidths (3 hash folds); best bandwidth first."""
    from fathom.operators import folds
    lat, lon = coords("c_custkey")
    c = Tables(spark, sf_dir).customer.select(F.col("c_custkey").alias("id"), lat.alias("lat"), lon.alias("lon"))
    scores = kde.bandwidth_scores(folds.kfold(c, ["id"], 3, "kde"), list(BANDWIDTHS))
    return scores.select("bandwidth", rnd("mean_log_likelihood", 6).alias("mean_log_likelihood"), "n_scored") \
        .orderBy(F.desc("mean_log_likelihood"))


GWR_X = ["orders", "spend"]
GWR_K = list(range(20, 201, 10))


def _gwr_points(spark, sf_dir):
    """Customers with their number of orders and what they spent, both standardised."""
    lat, lon = coords("c_custkey")
    t = Tables(spark, sf_dir)
    spent = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).cast("double").alias("orders"),
                                                                 F.sum("o_totalprice").alias("spend"))
    c = t.customer.select(F.col("c_custkey").alias("id"), lat.alias("lat"), lon.alias("lon"), "c_acctbal")
    pts = c.join(spent, "id", "left").fillna(0.0, subset=GWR_X)
    stats = pts.agg(*[f(x).alias(f"{n}_{x}") for x in GWR_X for f, n in ((F.avg, "m"), (F.stddev_pop, "s"))])  # one row
    scaled = {x: (F.col(x) - F.col(f"m_{x}")) / F.col(f"s_{x}") for x in GWR_X}
    return pts.crossJoin(F.broadcast(stats)).withColumns(scaled).select(*c.columns, *GWR_X)


def _det(m):
    """3 x 3 determinant as SQL text."""
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


_XX = [["s00", "s01", "s02"], ["s01", "s11", "s12"], ["s02", "s12", "s22"]]
_BETA = [_det([[f"t{r}" if j == c else _XX[r][j] for j in range(3)] for r in range(3)]) for c in range(3)]
_ONE = ["1", "x1", "x2"]
_HAT = _det(_XX)
# influence: x' (X'WX)^-1 x, each product of the inverse with x by Cramer's rule
_OWN = " + ".join(f"{_ONE[c]} * {_det([[_ONE[r] if j == c else _XX[r][j] for j in range(3)] for r in range(3)])}" for c in range(3))
_ACCUMULATED = ", ".join([f"sum(w * {'1' if i == 0 else f'n.x{i}'} * {'1' if j == 0 else f'n.x{j}'}) AS s{i}{j}"
                          for i in range(3) for j in range(i, 3)]
                         + [f"sum(w * {'1' if i == 0 else f'n.x{i}'} * n.y) AS t{i}" for i in range(3)])
SQL_GWR = f"""
sp AS (SELECT o_custkey AS id, CAST(count(*) AS DOUBLE) AS x1, sum(o_totalprice) AS x2 FROM orders GROUP BY 1),
u AS (SELECT c_custkey AS id, {LAT_C} AS lat, {LON_C} AS lon, c_acctbal AS y, coalesce(x1, 0) AS x1, coalesce(x2, 0) AS x2
      FROM customer LEFT JOIN sp ON sp.id = c_custkey),
p AS (SELECT id, lat, lon, y, (x1 - avg(x1) OVER ()) / stddev_pop(x1) OVER () AS x1,
             (x2 - avg(x2) OVER ()) / stddev_pop(x2) OVER () AS x2 FROM u),
d AS (SELECT a.id, b.id AS nb, round({_hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} * 1e6) / 1e6 AS d FROM p a JOIN p b ON a.id <> b.id),
r AS (SELECT id, nb, d, row_number() OVER (PARTITION BY id ORDER BY d, nb) AS rk FROM d QUALIFY rk < 200
      UNION ALL SELECT id, id, 0, 0 FROM p),
ks AS (SELECT unnest(range(20, 201)) AS k),
b AS (SELECT k, id, max(d) * 1.0000001e0 AS b FROM r JOIN ks ON rk = k - 1 GROUP BY ALL),
f AS (SELECT b.k, r.id, r.nb, CASE WHEN b > 0 THEN power(1 - power(d / b, 2), 2) ELSE 1 END AS w FROM r JOIN b ON r.id = b.id AND r.rk < b.k),
g AS (SELECT k, f.id, {_ACCUMULATED}, sum(w * n.y * n.y) AS yy FROM f JOIN p n ON n.id = f.nb /*which*/ GROUP BY ALL),
l AS (SELECT k, g.id, {", ".join(f"{_BETA[c]} / {_HAT} AS b{c}" for c in range(3))}, ({_OWN}) / {_HAT} AS influence, y, x1, x2,
             yy, s00, t0, t1, t2 FROM g JOIN p ON p.id = g.id),
a AS (SELECT k, count(*) AS n, sum(power(y - b0 - b1 * x1 - b2 * x2, 2)) AS rss, sum(influence) AS tr FROM l GROUP BY k),
t AS (SELECT k, n, rss, tr, n * ln(2 * pi() * rss / n) + n + 2 * n * (tr + 1) / (n - tr - 2) AS aicc FROM a)"""
_COARSE = f"WHERE k IN ({', '.join(map(str, GWR_K))})"


@query("gwr_bandwidths", ["G4"], sql=f"""
WITH {SQL_GWR.replace('/*which*/', _COARSE)}
SELECT CAST(k AS INTEGER) AS neighbours, n, {sql_rnd('rss / n', 2)} AS mean_square, {sql_rnd('tr', 6)} AS effective_parameters,
       {sql_rnd('aicc', 4)} AS aicc, aicc = min(aicc) OVER () AS best FROM t
""")
def gwr_bandwidths(spark, sf_dir):
    """AICc of the local regression of account balance on orders and spending, with 20 to 200 neighbours."""
    lists = gwr.neighbour_lists(_gwr_points(spark, sf_dir), "c_acctbal", GWR_X, GWR_K[-1])
    t = gwr.bandwidth_table(lists, len(GWR_X), GWR_K)
    least = t.agg(F.min("aicc").alias("__least"))
    return t.crossJoin(F.broadcast(least)).select(
        "neighbours", "n", rnd(F.col("rss") / F.col("n"), 2).alias("mean_square"), rnd("trace", 6).alias("effective_parameters"),
        rnd("aicc", 4).alias("aicc"), (F.col("aicc") == F.col("__least")).alias("best"))


@query("gwr_local_coefficients", ["G4"], sql=f"""
WITH {SQL_GWR.replace('/*which*/', '')},
k0 AS (SELECT arg_min(k, aicc) AS k0 FROM t WHERE k % 10 = 0),
kb AS (SELECT arg_min(k, aicc) AS kb FROM t CROSS JOIN k0 WHERE abs(k - k0) < 10)
SELECT id, CAST(kb AS INTEGER) AS neighbours, {sql_rnd('b0', 6)} AS intercept, {sql_rnd('b1', 6)} AS coef_orders,
       {sql_rnd('b2', 6)} AS coef_spend, {sql_rnd('influence', 6)} AS influence,
       {sql_rnd('y - b0 - b1 * x1 - b2 * x2', 6)} AS residual,
       {sql_rnd('1 - (yy - b0 * t0 - b1 * t1 - b2 * t2) / (yy - t0 * t0 / s00)', 6)} AS local_r2
FROM l CROSS JOIN kb WHERE k = kb
""")
def gwr_local_coefficients(spark, sf_dir):
    """Coefficients at every customer point with the number of neighbours of least AICc."""
    lists = gwr.neighbour_lists(_gwr_points(spark, sf_dir), "c_acctbal", GWR_X, GWR_K[-1])
    k = gwr.best_bandwidth(lists, len(GWR_X), GWR_K[0], GWR_K[-1])
    fits = gwr.local_fits(lists, GWR_X, k or GWR_K[-1])
    return fits.select("id", F.lit(k).cast("int").alias("neighbours"),
                       *[rnd(c, 6).alias(c) for c in ("intercept", *[f"coef_{x}" for x in GWR_X], "influence", "residual", "local_r2")])
