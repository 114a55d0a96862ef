"""Learnt-transform queries (L1-L14, L20, L23, L24): state fitted on the
training split only, applied to every row."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions.hashing import sql_bucket, sql_key_text, sql_unit_uniform
from fathom.functions.numeric import rnd, sql_rnd
from fathom.operators import folds, learned, mutual_info
from fathom.plans.common import LI_KEY, SQL_LI_MISSING, coords, lineitem_missing, sql_coords
from fathom.plans.registry import query
from fathom.sources.tables import Tables

LI_SPLIT_SQL = f"CASE WHEN {sql_bucket(sql_key_text(*LI_KEY), 'split')} < 80 THEN 'train' ELSE 'test' END"
P_SPLIT_SQL = f"CASE WHEN {sql_bucket(sql_key_text('p_partkey'), 'split')} < 80 THEN 'train' ELSE 'test' END"
C_SPLIT_SQL = f"CASE WHEN {sql_bucket(sql_key_text('c_custkey'), 'split')} < 80 THEN 'train' ELSE 'test' END"


def _li_split(spark, sf_dir):
    return folds.holdout(lineitem_missing(spark, sf_dir), LI_KEY)


@query("rare_category_bucket", ["L1"], sql=f"""
WITH p AS (SELECT p_partkey, p_brand || '/' || p_type AS lvl, {P_SPLIT_SQL} AS split FROM part),
kept AS (SELECT lvl FROM p WHERE split = 'train' GROUP BY lvl HAVING count(*) >= 10)
SELECT CASE WHEN p.lvl IS NULL THEN NULL WHEN kept.lvl IS NOT NULL THEN p.lvl ELSE 'Rare' END AS level, count(*) AS n
FROM p LEFT JOIN kept ON p.lvl = kept.lvl GROUP BY 1
""")
def rare_category_bucket(spark, sf_dir):
    p = Tables(spark, sf_dir).part.select("p_partkey", F.concat_ws("/", "p_brand", "p_type").alias("lvl"))
    p = folds.holdout(p, ["p_partkey"])
    kept = learned.fit_rare_levels(p.where(F.col("split") == "train"), "lvl", 10)
    out = learned.apply_rare_levels(p, kept, "lvl", "level")
    return out.groupBy("level").agg(F.count(F.lit(1)).alias("n"))


IMP = ["l_quantity", "l_extendedprice", "l_discount"]
# Report precision per column: the mean of 2-decimal values over n rows can
# sit exactly on a 6-decimal halfway point, so the discount keeps 8.
IMP_DIGITS = {"l_quantity": 6, "l_extendedprice": 4, "l_discount": 8}


@query("impute_median_indicator", ["L2"], sql=f"""
WITH {SQL_LI_MISSING},
s AS (SELECT *, {LI_SPLIT_SQL} AS split FROM li),
f AS (SELECT """ + ", ".join(f"quantile_cont({c}, 0.5) AS f_{c}, count(*) > count({c}) AS h_{c}" for c in IMP) + """
      FROM s WHERE split = 'train')
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {sql_rnd(f'any_value(f_{c})', 6)} AS fill_value, "
    f"{sql_rnd(f'avg(coalesce({c}, f_{c}))', IMP_DIGITS[c])} AS imputed_mean, "
    f"CAST(sum(CASE WHEN h_{c} THEN CAST({c} IS NULL AS INTEGER) END) AS BIGINT) AS n_indicator FROM s CROSS JOIN f"
    for c in IMP))
def impute_median_indicator(spark, sf_dir):
    s = _li_split(spark, sf_dir)
    state = learned.fit_imputer(s.where(F.col("split") == "train"), IMP, "median")
    out = learned.apply_imputer(s, state, IMP, indicator=True).crossJoin(F.broadcast(state))
    parts = [out.agg(F.lit(c).alias("column_name"), rnd(F.first(f"fill_{c}"), 6).alias("fill_value"),
                     rnd(F.avg(c), IMP_DIGITS[c]).alias("imputed_mean"), F.sum(f"{c}_missing").cast("long").alias("n_indicator"))
             for c in IMP]
    res = parts[0]
    for p in parts[1:]:
        res = res.unionByName(p)
    return res


@query("group_median_impute", ["L3", "J1"], sql=f"""
WITH {SQL_LI_MISSING},
s AS (SELECT *, {LI_SPLIT_SQL} AS split FROM li),
g AS (SELECT l_linestatus, quantile_cont(l_discount, 0.5) AS gmed FROM s WHERE split = 'train' GROUP BY l_linestatus),
o AS (SELECT quantile_cont(l_discount, 0.5) AS med FROM s WHERE split = 'train')
SELECT s.l_linestatus, count(*) FILTER (WHERE l_discount IS NULL) AS n_imputed,
       {sql_rnd('sum(coalesce(l_discount, gmed, med))', 6)} AS discount_sum
FROM s LEFT JOIN g USING (l_linestatus) CROSS JOIN o GROUP BY s.l_linestatus
""")
def group_median_impute(spark, sf_dir):
    s = _li_split(spark, sf_dir)
    state = learned.fit_group_median(s.where(F.col("split") == "train"), "l_discount", "l_linestatus")
    out = learned.apply_group_median(s.withColumn("was_null", F.col("l_discount").isNull()), state,
                                     "l_discount", "l_linestatus")
    return out.groupBy("l_linestatus").agg(F.count(F.when(F.col("was_null"), 1)).alias("n_imputed"),
                                           rnd(F.sum("l_discount"), 6).alias("discount_sum"))


WIN = ["l_extendedprice", "l_quantity"]


@query("winsorise", ["L6"], sql=f"""
WITH {SQL_LI_MISSING},
s AS (SELECT *, {LI_SPLIT_SQL} AS split FROM li),
q AS (SELECT """ + ", ".join(f"quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}" for c in WIN) + """
      FROM s WHERE split = 'train')
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {sql_rnd(f'min(least(greatest({c}, lo_{c}), hi_{c}))', 6)} AS min, "
    f"{sql_rnd(f'max(least(greatest({c}, lo_{c}), hi_{c}))', 6)} AS max, "
    f"{sql_rnd(f'avg(least(greatest({c}, lo_{c}), hi_{c}))', 6)} AS mean FROM s CROSS JOIN q" for c in WIN))
def winsorise(spark, sf_dir):
    s = _li_split(spark, sf_dir)
    state = learned.fit_winsor(s.where(F.col("split") == "train"), WIN)
    out = learned.apply_winsor(s, state, WIN)
    parts = [out.agg(F.lit(c).alias("column_name"), rnd(F.min(c), 6).alias("min"), rnd(F.max(c), 6).alias("max"),
                     rnd(F.avg(c), 6).alias("mean")) for c in WIN]
    return parts[0].unionByName(parts[1])


def _scaler_sql(kind, c):
    if kind == "standard":
        center, scale = f"avg({c})", f"stddev_pop({c})"
    elif kind == "robust":
        center, scale = f"quantile_cont({c}, 0.5)", f"quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"
    else:
        center, scale = f"min({c})", f"max({c}) - min({c})"
    z = f"(({c} - ce) / CASE WHEN sc = 0 THEN 1.0e0 ELSE sc END)"
    return (f"SELECT '{kind}' AS scaler, '{c}' AS column_name, {sql_rnd(f'avg({z})', 6)} AS mean_scaled, "
            f"{sql_rnd(f'min({z})', 6)} AS min_scaled, {sql_rnd(f'max({z})', 6)} AS max_scaled "
            f"FROM s CROSS JOIN (SELECT {center} AS ce, {scale} AS sc FROM s WHERE split = 'train')")


@query("robust_scale", ["L7", "L20"], sql=f"""
WITH {SQL_LI_MISSING},
s AS (SELECT *, {LI_SPLIT_SQL} AS split FROM li)
""" + "\nUNION ALL\n".join(_scaler_sql(k, c) for k in ["standard", "robust", "minmax"] for c in WIN))
def robust_scale(spark, sf_dir):
    s = _li_split(spark, sf_dir)
    train = s.where(F.col("split") == "train")
    res = None
    for kind in ["standard", "robust", "minmax"]:
        state = learned.fit_scaler(train, WIN, kind)
        out = learned.apply_scaler(s, state, WIN, suffix="_z")
        for c in WIN:
            part = out.agg(F.lit(kind).alias("scaler"), F.lit(c).alias("column_name"),
                           rnd(F.avg(f"{c}_z"), 6).alias("mean_scaled"), rnd(F.min(f"{c}_z"), 6).alias("min_scaled"),
                           rnd(F.max(f"{c}_z"), 6).alias("max_scaled"))
            res = part if res is None else res.unionByName(part)
    return res


@query("ordinal_onehot", ["L8", "L9", "L10"], sql="""
WITH tr AS (SELECT p_brand FROM part WHERE p_size <= 25),
lv AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS code
       FROM tr GROUP BY p_brand HAVING count(*) >= 40),
j AS (SELECT coalesce(lv.code, -1) AS code, part.p_brand FROM part LEFT JOIN lv USING (p_brand))
SELECT code, count(*) AS n, CAST(code > 0 AS INTEGER) AS has_onehot_column FROM j GROUP BY code
""")
def ordinal_onehot(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    levels = learned.fit_levels(p.where(F.col("p_size") <= 25), "p_brand", min_frequency=40)
    coded = learned.apply_ordinal(p, levels, "p_brand", "code")
    # drop='first': the level with code 0 has no indicator column; unknown (-1) is all zeros.
    return coded.groupBy("code").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("has_onehot_column", (F.col("code") > 0).cast("int"))


@query("one_hot", ["L8", "L9"], sql="""
WITH tr AS (SELECT p_brand, count(*) AS n FROM part WHERE p_size <= 25 GROUP BY p_brand),
ls AS (SELECT DISTINCT l_linestatus FROM lineitem)
SELECT 'brand' AS encoder, 'p_brand_' || tr.p_brand AS term, count(part.p_brand) AS n_ones
FROM tr LEFT JOIN part USING (p_brand) WHERE tr.n >= 40 GROUP BY ALL
UNION ALL SELECT 'brand', 'p_brand_infrequent', count(*) FROM part JOIN tr USING (p_brand) WHERE tr.n < 40
UNION ALL SELECT 'status', 'l_linestatus_' || l_linestatus, count(*) FROM lineitem
  WHERE l_linestatus <> (SELECT min(l_linestatus) FROM ls) OR (SELECT count(*) FROM ls) <> 2 GROUP BY ALL
UNION ALL SELECT 'status', 'l_linestatus_infrequent', 0
""")
def one_hot(spark, sf_dir):
    """Indicator columns with pooled rare levels (brands fitted on part of
    the rows) and with the binary drop rule, summed per column."""
    t = Tables(spark, sf_dir)
    out = None
    for name, fitted, df, col, low, drop in (
            ("brand", t.part.where(F.col("p_size") <= 25), t.part, "p_brand", 40, None),
            ("status", t.lineitem, t.lineitem, "l_linestatus", 1, "if_binary")):
        hot = learned.apply_one_hot(df.select(col), learned.fit_one_hot(fitted, col, low, drop), col)
        terms = [c for c in hot.columns if c != col]
        sums = hot.agg(*[F.sum(f"`{c}`").alias(c) for c in terms]).select(F.explode(F.array(*[
            F.struct(F.lit(name).alias("encoder"), F.lit(c).alias("term"),
                     F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias("n_ones")) for c in terms])).alias("x")).select("x.*")
        out = sums if out is None else out.unionByName(sums)
    return out


@query("target_encode", ["L11", "J1"], sql=f"""
WITH c AS (SELECT c_custkey, c_mktsegment, c_acctbal, {C_SPLIT_SQL} AS split FROM customer),
g AS (SELECT avg(c_acctbal) AS gm FROM c WHERE split = 'train'),
lv AS (SELECT c_mktsegment, (count(*) * avg(c_acctbal) + 20.0e0 * (SELECT gm FROM g)) / (count(*) + 20.0e0) AS enc
       FROM c WHERE split = 'train' GROUP BY c_mktsegment)
SELECT c.split, c.c_mktsegment, count(*) AS n, {sql_rnd('any_value(coalesce(lv.enc, (SELECT gm FROM g)))', 6)} AS encoding
FROM c LEFT JOIN lv USING (c_mktsegment) GROUP BY ALL
""")
def target_encode(spark, sf_dir):
    c = folds.holdout(Tables(spark, sf_dir).customer.select("c_custkey", "c_mktsegment", "c_acctbal"), ["c_custkey"])
    state = learned.fit_target_encoding(c.where(F.col("split") == "train"), "c_mktsegment", "c_acctbal", 20.0)
    out = learned.apply_target_encoding(c, state, "c_mktsegment", "encoding")
    return out.groupBy("split", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"),
                                                    rnd(F.first("encoding"), 6).alias("encoding"))


@query("oof_target_encode", ["L12", "F6"], sql=f"""
WITH o AS (SELECT o_orderpriority, o_totalprice, CAST({sql_bucket(sql_key_text('o_orderkey'), 'kfold', 5)} AS INTEGER) AS fold
           FROM orders),
pf AS (SELECT o_orderpriority, fold, count(*) AS fn, sum(o_totalprice) AS fs FROM o GROUP BY ALL),
pl AS (SELECT o_orderpriority, count(*) AS ln, sum(o_totalprice) AS ls FROM o GROUP BY ALL),
ft AS (SELECT fold, count(*) AS tn, sum(o_totalprice) AS ts FROM o GROUP BY ALL),
al AS (SELECT count(*) AS an, sum(o_totalprice) AS asum FROM o),
r AS (SELECT pf.o_orderpriority, pf.fold, ln - fn AS n_out, ls - fs AS s_out, (asum - ts) / (an - tn) AS g_out
      FROM pf JOIN pl USING (o_orderpriority) JOIN ft USING (fold) CROSS JOIN al)
SELECT o_orderpriority, fold, {sql_rnd('CASE WHEN n_out > 0 THEN (s_out + 10.0e0 * g_out) / (n_out + 10.0e0) ELSE g_out END', 6)} AS encoding
FROM r
""")
def oof_target_encode(spark, sf_dir):
    o = folds.kfold(Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderpriority", "o_totalprice"),
                    ["o_orderkey"], 5)
    out = learned.oof_target_encoding(o, "o_orderpriority", "o_totalprice", "fold", "encoding", 10.0)
    return out.groupBy("o_orderpriority", "fold").agg(rnd(F.first("encoding"), 6).alias("encoding"))


POLY = ["l_quantity", "l_discount", "l_tax"]


def _poly_sql():
    from itertools import combinations_with_replacement
    cols = []
    for d in (1, 2):
        for combo in combinations_with_replacement(POLY, d):
            name = "*".join(combo)
            expr = "1.0e0 * " + " * ".join(combo)
            cols.append(f"SELECT '{name}' AS term, {sql_rnd(f'sum({expr})', 4)} AS total FROM lineitem")
    return "\nUNION ALL\n".join(cols)


@query("poly_features", ["L13"], sql=_poly_sql())
def poly_features(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    terms = learned.polynomial_columns(POLY, 2)
    agg = li.agg(*[F.sum(e).alias(n) for n, e in terms.items()])
    stack = ", ".join(f"'{n}', `{n}`" for n in terms)
    return agg.selectExpr(f"stack({len(terms)}, {stack}) as (term, total)").withColumn("total", rnd("total", 4))


KNOTS = [900.0, 925.0, 950.0, 975.0, 1000.0]


def _bspline_sql(x: str, knots, degree: int):
    t = [knots[0]] * degree + list(knots) + [knots[-1]] * degree
    xc = f"least(greatest({x}, {knots[0]!r}e0), {knots[-1]!r}e0)"
    m = len(t) - 1
    basis = []
    for i in range(m):
        if t[i] == t[i + 1]:
            basis.append("0.0e0")
            continue
        hi_op = "<=" if t[i + 1] == t[-1] else "<"
        basis.append(f"(CASE WHEN {xc} >= {t[i]!r}e0 AND {xc} {hi_op} {t[i + 1]!r}e0 THEN 1.0e0 ELSE 0.0e0 END)")
    for d in range(1, degree + 1):
        nxt = []
        for i in range(m - d):
            left = "0.0e0" if t[i + d] == t[i] else f"(({xc} - {t[i]!r}e0) / {t[i + d] - t[i]!r}e0 * {basis[i]})"
            right = "0.0e0" if t[i + d + 1] == t[i + 1] else \
                f"(({t[i + d + 1]!r}e0 - {xc}) / {t[i + d + 1] - t[i + 1]!r}e0 * {basis[i + 1]})"
            nxt.append(f"({left} + {right})")
        basis = nxt
    return basis


@query("bspline_basis", ["L14"], sql="\nUNION ALL\n".join(
    f"SELECT 'bs_{i}' AS term, {sql_rnd(f'sum({b})', 6)} AS total FROM part"
    for i, b in enumerate(_bspline_sql("p_retailprice", KNOTS, 3))))
def bspline_basis(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    cols = learned.bspline_columns(F.col("p_retailprice"), KNOTS, 3)
    agg = p.agg(*[F.sum(e).alias(n) for n, e in cols.items()])
    stack = ", ".join(f"'{n}', `{n}`" for n in cols)
    return agg.selectExpr(f"stack({len(cols)}, {stack}) as (term, total)").withColumn("total", rnd("total", 6))


FS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query("univariate_f_score", ["L23"], sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {sql_rnd(f'corr({c}, l_extendedprice)', 6)} AS r, "
    f"{sql_rnd(f'power(corr({c}, l_extendedprice), 2) / (1 - power(corr({c}, l_extendedprice), 2)) * (count(*) - 2)', 6)} AS f_score FROM lineitem" for c in FS))
def univariate_f_score(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem.withColumn("l_linenumber", F.col("l_linenumber").cast("double"))
    r = learned.f_scores(li, FS, "l_extendedprice")
    return r.select("feature", rnd("r", 6).alias("r"), rnd("f_score", 6).alias("f_score"))


N_BINS = 10
_MI_FEATURES = ["l_quantity", "l_discount", "l_tax"]
_EDGES_SQL = "[" + ", ".join(f"{i / N_BINS}e0" for i in range(1, N_BINS)) + "]"


def _sql_bin(col: str, edges: str) -> str:
    return f"len(list_filter({edges}, lambda e: e < {col}))"


def _sql_mi(x: str) -> str:
    return f"""
q_{x} AS (SELECT quantile_cont({x}, {_EDGES_SQL}) AS ex, quantile_cont(l_extendedprice, {_EDGES_SQL}) AS ey,
                corr({x}, l_extendedprice) AS r FROM lineitem),
j_{x} AS (SELECT {_sql_bin(x, 'ex')} AS xb, {_sql_bin('l_extendedprice', 'ey')} AS yb, count(*) AS nxy
          FROM lineitem CROSS JOIN q_{x} GROUP BY ALL),
m_{x} AS (SELECT sum(nxy / n * ln(nxy * n / (nx * ny))) AS mi
          FROM (SELECT *, sum(nxy) OVER (PARTITION BY xb) AS nx, sum(nxy) OVER (PARTITION BY yb) AS ny,
                       sum(nxy) OVER () AS n FROM j_{x}))"""


def _count_below(c):
    return lambda acc, e: acc + F.when(e < F.col(c), 1).otherwise(0)


def _quantile_bins(df, cols):
    """Equal-frequency bin of each column: how many of its exact decile edges lie below the value."""
    from fathom.operators.ordered import quantile_row
    edges = quantile_row(df, cols, [i / N_BINS for i in range(1, N_BINS)], "__e_")
    j = df.crossJoin(F.broadcast(edges))
    return j.withColumns({f"b_{c}": F.aggregate(f"__e_{c}", F.lit(0), _count_below(c)) for c in cols})


@query("mutual_info_binned", ["L24"], sql="WITH" + _sql_mi("l_quantity") + f"""
SELECT {sql_rnd('mi', 8)} AS mutual_info FROM m_l_quantity
""")
def mutual_info_binned(spark, sf_dir):
    li = _quantile_bins(Tables(spark, sf_dir).lineitem.select("l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"])
    return learned.binned_mutual_information(li, F.col("b_l_quantity"), F.col("b_l_extendedprice")).select(
        rnd("mutual_info", 8).alias("mutual_info"))


MI_NAMES, MI_K = ["orders", "c_acctbal", "lat", "lon"], 3
_LAT, _LON = sql_coords("c_custkey")


def _sql_grid(axis):
    return (f"CAST(floor((f.{axis} / s{axis} + ({sql_unit_uniform(f'concat(CAST(f.id AS VARCHAR), {chr(39)}-{axis}{chr(39)})', 'jitter')} - 0.5e0) "
            f"* {mutual_info.JITTER!r} * greatest(1.0e0, m{axis} / s{axis})) * {mutual_info.SCALE!r}e0) AS BIGINT) AS {axis}")


@query("mutual_info_neighbours", ["L24"], sql=f"""
WITH sp AS (SELECT o_custkey AS id, CAST(count(*) AS DOUBLE) AS orders, sum(o_totalprice) AS spend FROM orders GROUP BY 1),
c AS (SELECT c_custkey AS id, coalesce(orders, 0) AS orders, coalesce(spend, 0) AS spend, c_acctbal, {_LAT} AS lat, {_LON} AS lon
      FROM customer LEFT JOIN sp ON sp.id = c_custkey),
f AS ({" UNION ALL ".join(f"SELECT '{n}' AS feature, id, {n} AS x, spend AS y FROM c" for n in MI_NAMES)}),
st AS (SELECT feature, stddev_pop(x) AS sx, avg(abs(x)) AS mx, stddev_pop(y) AS sy, avg(abs(y)) AS my FROM f GROUP BY 1),
g AS (SELECT f.feature, f.id, {_sql_grid('x')}, {_sql_grid('y')} FROM f JOIN st USING (feature)),
d AS (SELECT a.feature, a.id, greatest(abs(a.x - b.x), abs(a.y - b.y)) AS d FROM g a JOIN g b ON a.feature = b.feature AND a.id <> b.id),
r AS (SELECT feature, id, d AS r FROM d QUALIFY row_number() OVER (PARTITION BY feature, id ORDER BY d) = {MI_K}),
nn AS (SELECT a.feature, a.id, count(*) FILTER (WHERE abs(a.x - b.x) < r) AS nx, count(*) FILTER (WHERE abs(a.y - b.y) < r) AS ny
       FROM g a JOIN r ON a.feature = r.feature AND a.id = r.id JOIN g b ON a.feature = b.feature AND a.id <> b.id GROUP BY ALL),
t AS (SELECT feature, count(*) AS n, sum({mutual_info.digamma_sql('(nx + 1)')} + {mutual_info.digamma_sql('(ny + 1)')}) AS s FROM nn GROUP BY 1)
SELECT feature, n, {sql_rnd(f"greatest({mutual_info.digamma_sql('n')} + {mutual_info.digamma_sql(str(MI_K))} - s / n, 0.0e0)", 6)} AS mutual_information FROM t
""")
def mutual_info_neighbours(spark, sf_dir):
    """What a customer's spending shares with the number of orders, the balance and the place, by three nearest neighbours."""
    lat, lon = coords("c_custkey")
    t = Tables(spark, sf_dir)
    spent = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).cast("double").alias("orders"),
                                                                 F.sum("o_totalprice").alias("spend"))
    c = t.customer.select(F.col("c_custkey").alias("id"), "c_acctbal", lat.alias("lat"), lon.alias("lon")) \
        .join(spent, "id", "left").fillna(0.0, subset=["orders", "spend"])
    mi = mutual_info.neighbour_information(c, "id", MI_NAMES, "spend", MI_K)
    return mi.select("feature", "n", rnd("mutual_information", 6).alias("mutual_information"))


@query("pearson_mi_discrepancy", ["A8"], sql="WITH" + ",".join(_sql_mi(x) for x in _MI_FEATURES) + "\nUNION ALL\n".join(
    f"""
SELECT '{x}' AS feature, {sql_rnd('abs(r)', 8)} AS abs_pearson, {sql_rnd('mi', 8)} AS mutual_info,
       {sql_rnd('sqrt(1 - exp(-2 * mi)) - abs(r)', 6)} AS discrepancy FROM m_{x} CROSS JOIN q_{x}""" for x in _MI_FEATURES))
def pearson_mi_discrepancy(spark, sf_dir):
    """Dependence that the linear correlation misses: the correlation that a
    Gaussian pair with this mutual information has, less |Pearson|."""
    y = "l_extendedprice"
    li = _quantile_bins(Tables(spark, sf_dir).lineitem.select(*_MI_FEATURES, y), [*_MI_FEATURES, y])
    out = None
    for x in _MI_FEATURES:
        mi = learned.binned_mutual_information(li, F.col(f"b_{x}"), F.col(f"b_{y}"))
        r = li.agg(F.abs(F.corr(x, y)).alias("r"))
        row = mi.crossJoin(r).select(F.lit(x).alias("feature"), rnd("r", 8).alias("abs_pearson"),
                                     rnd("mutual_info", 8).alias("mutual_info"),
                                     rnd(F.sqrt(1 - F.exp(-2 * F.col("mutual_info"))) - F.col("r"), 6).alias("discrepancy"))
        out = row if out is None else out.unionByName(row)
    return out
