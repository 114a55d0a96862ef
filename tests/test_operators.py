"""Hand-made fixtures (<= 10 rows) for the edge rules, identities and
metamorphic checks of the operators."""

import math

import pytest
from pyspark.sql import functions as F

from fathom.functions import special
from fathom.operators import contract, drift, evalcls, evalreg, folds, learned, ordered, stattests, survival


def df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_running_totals_partition_invariant(spark):
    rows = [(i % 3, float((i * 7) % 11), i) for i in range(60)]
    d = df(spark, rows, "g int, x double, k int")
    expected = None
    for parts in (1, 7, 64):
        r = ordered.row_numbers(d, ["x", "k"], ["g"], num_partitions=parts).orderBy("k").collect()
        got = [(row.k, row.rn) for row in r]
        expected = expected or got
        assert got == expected
    # brute force
    for k, rn in expected:
        g, x = rows[k][0], rows[k][1]
        assert rn == sum(1 for (gg, xx, kk) in rows if gg == g and (xx, kk) <= (x, k))


def test_ntile_matches_sql_rule(spark):
    d = df(spark, [(i,) for i in range(10)], "k int")
    t = folds.ordered_tiles(d, ["k"], 4, "tile").orderBy("k").collect()
    assert [r.tile for r in t] == [1, 1, 1, 2, 2, 2, 3, 3, 4, 4]


def test_qcut_edges_and_bins(spark):
    d = df(spark, [(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8]], "x double")
    e = folds.qcut_edges(d, "x", 4)
    b = folds.qcut_assign(d, "x", e, "bin").orderBy("x").collect()
    assert [r.bin for r in b] == [0, 0, 1, 1, 2, 2, 3, 3]
    same = df(spark, [(2.0,), (2.0,), (2.0,)], "x double")
    e2 = folds.qcut_edges(same, "x", 4).first().edges
    assert e2 == [2.0]


def test_stratified_holdout_exact_counts(spark):
    rows = [(i, "a" if i < 7 else "b") for i in range(10)]
    s = folds.stratified_holdout(df(spark, rows, "k int, s string"), ["k"], ["s"], 20)
    c = {r.s: r.n for r in s.where("split = 'test'").groupBy("s").agg(F.count("*").alias("n")).collect()}
    assert c == {"a": 1, "b": 1}


def test_fold_sizes_sum_to_n(spark):
    d = df(spark, [(i,) for i in range(100)], "k int")
    f = folds.kfold(d, ["k"], 5)
    assert f.count() == 100 and f.where("fold < 0 OR fold >= 5").count() == 0


def test_auc_ties_one_class_and_reversal(spark):
    d = df(spark, [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1)], "y int, s double")
    auc = evalcls.roc_auc(d, "y", "s").first().roc_auc
    assert auc == pytest.approx(2.5 / 4)  # pairs: tie 0.5, 1, 0, 1
    rev = evalcls.roc_auc(d.withColumn("s", -F.col("s")), "y", "s").first().roc_auc
    assert rev == pytest.approx(1 - auc)
    one = df(spark, [(1, 0.3), (1, 0.4)], "y int, s double")
    assert evalcls.roc_auc(one, "y", "s").first().roc_auc is None


def test_no_predicted_positive_gives_zero_precision(spark):
    d = df(spark, [(1, 0.1), (0, 0.2)], "y int, s double")
    m = evalcls.binary_metrics(d, "y", "s", 0.5).first()
    assert m.precision == 0.0 and m.f1 == 0.0


def test_zero_error_has_no_severity(spark):
    d = df(spark, [(1.0, 1.0), (2.0, 0.0), (3.0, 3.1)], "y double, p double")
    e = evalreg.error_rows(d, "y", "p")
    assert e.count() == 1 and e.first().severity == "high"  # rmse 1.157: 2.0 is within 2 x rmse


def test_psi_of_table_with_itself_is_zero(spark):
    d = df(spark, [("f", float(v)) for v in range(20)], "feature string, x double")
    assert drift.psi(d, d).first().psi == pytest.approx(0.0, abs=1e-12)


def test_psi_outside_range_kept_in_denominator(spark):
    ref = df(spark, [("f", float(v)) for v in range(10)], "feature string, x double")
    cur = df(spark, [("f", 100.0), ("f", 1.0)], "feature string, x double")
    p = drift.psi(ref, cur, bins=10).first()
    assert p.n_current == 2 and p.psi > 0


def test_ks_needs_ten_values(spark):
    ref = df(spark, [("f", float(v)) for v in range(100)], "feature string, x double")
    cur = df(spark, [("f", float(v)) for v in range(9)], "feature string, x double")
    assert drift.ks_against_points(ref, cur).count() == 0


def test_km_without_censoring_is_one_minus_ecdf(spark):
    d = df(spark, [(float(t), 1) for t in [1, 2, 2, 3, 5]], "t double, e int")
    km = survival.kaplan_meier(d, "t", "e").orderBy("time").collect()
    assert [round(r.survival, 10) for r in km] == [0.8, 0.4, 0.2, 0.0]
    allc = df(spark, [(1.0, 0), (2.0, 0)], "t double, e int")
    assert survival.median_survival(survival.kaplan_meier(allc, "t", "e")).first().median_time is None


def test_c_index_perfect_and_tied(spark):
    d = df(spark, [(1.0, 1, 3), (2.0, 1, 2), (3.0, 0, 1)], "t double, e int, r int")
    assert survival.c_index(d, "t", "e", "r").first().c_index == pytest.approx(1.0)
    t = df(spark, [(1.0, 1, 1), (2.0, 1, 1)], "t double, e int, r int")
    assert survival.c_index(t, "t", "e", "r").first().c_index == pytest.approx(0.5)


def test_unknown_levels(spark):
    train = df(spark, [("a",)] * 12 + [("b",)], "c string")
    kept = learned.fit_rare_levels(train, "c", 10)
    scored = learned.apply_rare_levels(df(spark, [("a",), ("b",), ("z",)], "c string"), kept, "c", "o")
    assert sorted(r.o for r in scored.collect()) == ["Rare", "Rare", "a"]
    tr = df(spark, [("a", 1.0), ("a", 3.0)], "c string, y double")
    st = learned.fit_target_encoding(tr, "c", "y", 0.0)
    enc = learned.apply_target_encoding(df(spark, [("q",)], "c string"), st, "c", "e").first().e
    assert enc == pytest.approx(2.0)


def test_missing_required_column_is_fatal(spark):
    d = df(spark, [(1,)], "a int")
    with pytest.raises(ValueError):
        contract.require_columns(d, ["a", "b"])


def test_equal_scores_give_p_one(spark):
    diffs = df(spark, [("m", 0, 0.0), ("m", 1, 0.0)], "model string, fold int, d double")
    w = stattests.wilcoxon_signed(diffs, ["model"]).withColumn("p", stattests.two_sided_p("z")).first()
    assert w.p == 1.0


def test_special_functions():
    assert special.norm_cdf(0) == pytest.approx(0.5)
    assert special.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-6)
    assert special.t_sf(2.0, 10) == pytest.approx(0.036694, rel=1e-4)
    assert special.ks_sf(1.36) == pytest.approx(0.0494, abs=1e-3)
    assert special.norm_ppf(0.975) == pytest.approx(1.959963985, rel=1e-8)


def test_sql_normal_cdf_matches_scalar(spark):
    v = spark.range(1).select(F.expr(special.sql_norm_cdf("1.2e0")).alias("c")).first().c
    assert v == pytest.approx(special.norm_cdf(1.2), abs=1e-7)
    c2 = spark.range(1).select(F.expr(special.sql_chi2_sf("5.0e0", 3)).alias("c")).first().c
    assert c2 == pytest.approx(special.chi2_sf(5.0, 3), abs=5e-3)


def test_shuffled_input_same_result(spark):
    rows = [(i, float(i % 7), i % 2) for i in range(50)]
    a = df(spark, rows, "k int, s double, y int")
    b = df(spark, list(reversed(rows)), "k int, s double, y int").repartition(5)
    assert evalcls.roc_auc(a, "y", "s").first().roc_auc == pytest.approx(evalcls.roc_auc(b, "y", "s").first().roc_auc)
    assert math.isfinite(evalcls.roc_auc(a, "y", "s").first().roc_auc)


def test_distributed_exact_quantiles_match_percentile(spark):
    from fathom.operators.ordered import exact_quantiles
    rows = [("a", float((i * 37) % 101)) for i in range(200)] + [("b", float(v)) for v in (5, 1, 3)]
    d = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r.quantiles for r in exact_quantiles(d, "x", probs, ["g"]).collect()}
    want = {r.g: r.q for r in d.groupBy("g").agg(F.percentile("x", probs).alias("q")).collect()}
    for g in want:
        assert got[g] == pytest.approx(want[g])


def _cox_numpy(t, e, x, pen):
    """Brute-force Breslow partial likelihood Newton solve for the test."""
    import numpy as np
    t, e, x = np.asarray(t, float), np.asarray(e, float), np.asarray(x, float).reshape(len(t), -1)
    b = np.zeros(x.shape[1])
    for _ in range(50):
        w = np.exp(x @ b)
        g = -pen * b
        h = pen * np.eye(len(b))
        for tt in np.unique(t[e == 1]):
            dset = (t == tt) & (e == 1)
            rs = t >= tt
            r0 = w[rs].sum()
            r1 = (w[rs, None] * x[rs]).sum(0)
            r2 = (w[rs, None, None] * x[rs][:, :, None] * x[rs][:, None, :]).sum(0)
            d = dset.sum()
            g += x[dset].sum(0) - d * r1 / r0
            h += d * (r2 / r0 - np.outer(r1 / r0, r1 / r0))
        b = b + np.linalg.solve(h, g)
    return b


def test_cox_matches_brute_force(spark):
    from fathom.operators.survival_models import cox_ph
    t = [1.0, 2.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0]
    e = [1, 1, 0, 1, 1, 0, 1, 1]
    x = [1.0, 0.0, 1.0, 1.0, 0.0, 0.0, 1.0, 0.0]
    d = spark.createDataFrame(list(zip(t, e, x)), "t double, e int, x double")
    fit = cox_ph(d, "t", "e", ["x"], penalizer=0.1)
    assert fit["coef"][0] == pytest.approx(_cox_numpy(t, e, x, 0.1)[0], abs=1e-6)


def test_tobit_without_censoring_is_least_squares(spark):
    from fathom.operators.survival_models import tobit
    rows = [(float(2 + 0.5 * i + ((i * 7) % 5 - 2) * 0.3), 0, float(i)) for i in range(30)]
    d = spark.createDataFrame(rows, "y double, c int, x double")
    fit = tobit(d, "y", "c", ["x"])
    assert fit["coef"][0] == pytest.approx(fit["ols"][1], rel=1e-5)
    assert fit["sigma"] == pytest.approx(fit["ols_sigma"], rel=1e-4)


def _knn_brute(q, r, k):
    import numpy as np
    out = {}
    for qid, qx in q:
        ds = sorted((float(np.sqrt(((np.array(qx) - np.array(rx)) ** 2).sum())), rid) for rid, rx in r)
        out[qid] = [(rid, d) for d, rid in ds[:k]]
    return out


@pytest.mark.parametrize("n_ref,n_q,d,k", [(300, 80, 2, 5), (50, 30, 1, 7), (4, 10, 2, 5), (400, 60, 3, 3)])
def test_grid_knn_equals_brute_force(spark, n_ref, n_q, d, k):
    """Clustered and duplicate-heavy points, a far outlier, fewer refs than k:
    the level-climbing grid search must return the exact k nearest."""
    import numpy as np
    from fathom.operators.neighbors import knn
    rng = np.random.default_rng(n_ref + d)
    r = [(i, [float(v) for v in np.round(rng.normal(size=d) * (1 if i % 3 else 0.01), 2)]) for i in range(n_ref)]
    r += [(n_ref + j, [0.5] * d) for j in range(40)]  # one hot point
    q = [(1000 + i, [float(v) for v in np.round(rng.normal(size=d), 2)]) for i in range(n_q)]
    q += [(5000, [50.0] * d), (5001, [0.5] * d), (5002, [0.5] * d)]
    cols = [f"f{i}" for i in range(d)]
    rdf = spark.createDataFrame([(a, *b) for a, b in r], ["rid", *cols])
    qdf = spark.createDataFrame([(a, *b) for a, b in q], ["qid", *cols])
    got = {}
    for row in sorted(knn(qdf, rdf, cols, k, cap=8).collect(), key=lambda x: (x.qid, x["rank"])):
        got.setdefault(row.qid, []).append((row.rid, row.distance))
    want = _knn_brute(q, r, k)
    assert set(got) == set(want)
    for qid, nb in want.items():
        assert [x[0] for x in got[qid]] == [x[0] for x in nb], qid
        assert np.allclose([x[1] for x in got[qid]], [x[1] for x in nb])


def test_knn_distance_weights_and_vote(spark):
    from fathom.operators.neighbors import class_vote, weighted_mean
    nb = spark.createDataFrame([(1, 1, 10.0, 1.0, "a"), (1, 2, 20.0, 2.0, "b"), (1, 3, 40.0, 2.0, "b"),
                                (2, 1, 5.0, 0.0, "a"), (2, 2, 7.0, 0.0, "b"), (2, 3, 99.0, 1.0, "b")],
                               "q int, rank int, v double, distance double, y string")
    m = {r.q: r.v for r in weighted_mean(nb, "q", "v", "distance").collect()}
    assert m[1] == pytest.approx((10 / 1 + 20 / 2 + 40 / 2) / (1 + 0.5 + 0.5))
    assert m[2] == pytest.approx(6.0)  # zero-distance neighbours take all the weight
    u = {r.q: r.v for r in weighted_mean(nb, "q", "v", "uniform").collect()}
    assert u[2] == pytest.approx(37.0)
    v = {(r.q, r.y): (r.share, r.prediction) for r in class_vote(nb, "q", "y").collect()}
    assert v[(1, "b")] == (pytest.approx(0.5), "a")  # 1.0 vs 0.5 + 0.5: tie goes to the smaller class
    assert v[(2, "a")][0] == pytest.approx(0.5)


def test_knn_impute_equals_brute_force(spark):
    """L4 on a fixture with NULL targets and duplicate coordinates: the
    filled values equal a brute-force k-NN (ties by donor key), directly
    and from a reused k=7 donor table."""
    import numpy as np
    from fathom.operators.neighbors import impute_neighbours, knn_impute
    rng = np.random.default_rng(7)
    rows = []
    for i in range(200):
        x = [float(v) for v in np.round(rng.normal(size=2), 1)]
        y = None if i % 4 == 0 else float(round(rng.normal() * 10, 3))
        rows.append((i, *x, y))
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    donors = [(r[0], r[1:3]) for r in rows if r[3] is not None]
    yv = {r[0]: r[3] for r in rows}
    nb7 = impute_neighbours(df, "id", "y", ["a", "b"], 7)
    for k, w in [(5, "uniform"), (7, "distance")]:
        for reuse in (None, nb7):
            got = {r.id: (r.y, r.missing_y) for r in knn_impute(df, "id", "y", ["a", "b"], k, w, nb=reuse).collect()}
            for i, a, b, y in rows:
                if y is not None:
                    assert got[i] == (y, False)
                    continue
                nb = _knn_brute([(i, [a, b])], donors, k)[i]
                ds = np.array([d for _, d in nb])
                vs = np.array([yv[j] for j, _ in nb])
                if w == "uniform":
                    want = vs.mean()
                elif (ds == 0).any():
                    want = vs[ds == 0].mean()
                else:
                    want = (vs / ds).sum() / (1 / ds).sum()
                assert got[i][1] is True and got[i][0] == pytest.approx(want), (i, k, w)


def test_spatial_knn_hot_point_and_isolated_point(spark):
    """Haversine KNN equals brute force (rounded km, then id) with 60
    suppliers on one spot and a point alone on the far side of the globe."""
    import math
    from fathom.operators.spatial import knn
    pts = [(i, -60.0 + (i * 7919 % 12001) / 100.0, -180.0 + (i * 104729 % 36001) / 100.0) for i in range(1, 121)]
    pts += [(1000 + j, 10.0, 20.0) for j in range(60)] + [(5000, -89.5, 179.9)]

    def hav(a, b):
        p1, p2 = math.radians(a[1]), math.radians(b[1])
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return round(2 * 6371.0 * math.asin(math.sqrt(h)) * 1e6) / 1e6
    k = 5
    df = spark.createDataFrame(pts, "id long, lat double, lon double")
    got = {}
    for r in sorted(knn(df, k).collect(), key=lambda r: (r.id, r["rank"])):
        got.setdefault(r.id, []).append(r.neighbour)
    for p in pts:
        want = [q[0] for q in sorted((q for q in pts if q[0] != p[0]), key=lambda q: (hav(p, q), q[0]))[:k]]
        assert got[p[0]] == want, p


def test_column_quantiles_distributed_equals_builtin(spark):
    """The distributed exact path (forced with limit=0) equals the built-in
    map-based percentile per (group, column); an all-NULL column has no row
    and ``quantile_row`` gives NULL for it."""
    from pyspark.sql import functions as F
    from fathom.operators.ordered import column_quantiles, quantile_row
    rows = [(i % 3, float(i % 17) if i % 5 else None, float((i * 7) % 11) / 3, None) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, a double, b double, z double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g, r.column_name): r.quantiles for r in column_quantiles(df, ["a", "b", "z"], probs, ["g"]).collect()}
    assert all(k[1] != "z" for k in got)
    for c in ["a", "b"]:
        for r in df.groupBy("g").agg(F.percentile(c, probs).alias("q")).collect():
            assert got[(r.g, c)] == pytest.approx(r.q), (r.g, c)
    one = quantile_row(df, ["a", "z"], [0.5]).first()
    assert one.q_a[0] == pytest.approx(df.agg(F.percentile("a", 0.5)).first()[0]) and one.q_z is None


def test_c_index_exact_for_continuous_risk(spark):
    """Harrell's C over 400 subjects with ~300 distinct risks, tied times,
    tied risks and a NULL event equals the O(n^2) pair count."""
    import numpy as np
    from fathom.operators.survival import c_index
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        t = int(rng.integers(1, 60))
        e = None if i == 7 else int(rng.random() < 0.6)
        risk = float(np.round(rng.normal(), 2))
        rows.append((i, t, e, risk))
    conc = tied = comp = 0
    for _, ti, ei, ri in rows:
        if ei != 1:
            continue
        for _, tj, _, rj in rows:
            if ti < tj:
                comp += 1
                conc += ri > rj
                tied += ri == rj
    df = spark.createDataFrame(rows, "id int, duration int, event int, risk double")
    got = c_index(df, "duration", "event", "risk").first()
    assert (got.concordant, got.tied, got.comparable) == (conc, tied, comp)
    assert got.c_index == pytest.approx((conc + 0.5 * tied) / comp)


def test_half_report_equals_separate_drift_operators(spark):
    from fathom.operators import drift
    rows = []
    for i in range(200):
        h = "reference" if i % 2 else "current"
        rows.append((h, "a", None if i % 7 == 0 else float(i % 13) + (5.0 if h == "current" else 0.0)))
        rows.append((h, "b", 3.0))                                   # constant: zero-width range
        rows.append((h, "c", float(i) if h == "reference" else None))  # no current values
    lv = spark.createDataFrame(rows, "half string, feature string, x double")
    got = {r.feature: r.asDict() for r in drift.half_report(lv).collect()}
    ref, cur = lv.where("half = 'reference'"), lv.where("half = 'current'")
    md = {r.feature: r for r in drift.missing_drift(ref, cur).collect()}
    ps = {r.feature: r for r in drift.psi(ref, cur).collect()}
    pr, pc = ({r.feature: r for r in drift.profile_stats(x).collect()} for x in (ref, cur))
    assert set(got) == set(ps) == {"a", "b"}
    for f, g in got.items():
        assert g["train_missing_rate"] == pytest.approx(md[f].train_missing_rate)
        assert g["current_missing_rate"] == pytest.approx(md[f].current_missing_rate)
        assert g["missing_alert"] == md[f].missing_alert
        assert g["psi"] == pytest.approx(ps[f].psi) and g["n_current"] == ps[f].n_current
        assert g["train_mean"] == pytest.approx(pr[f].mean) and g["current_std"] == pytest.approx(pc[f].std)


def test_exact_mean_order_independent_and_fallback(spark):
    """A mean on a 6-decimal halfway point is the same double under any
    partitioning; a value too large for the decimal falls back to avg."""
    from pyspark.sql import functions as F
    from fathom.functions.numeric import exact_mean
    vals = [0.01 * (i % 11) for i in range(6000)]
    vals[0] += 0.03
    from decimal import Decimal
    want = float(sum(Decimal(repr(v)).quantize(Decimal("1e-10")) for v in vals)) / len(vals)
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {df.repartition(n).agg(exact_mean("x").alias("m")).first().m for n in (1, 3, 7)}
    assert len(got) == 1 and got.pop() == want
    big = spark.createDataFrame([(1e30,), (1.0,), (None,)], "x double")
    r = big.agg(exact_mean("x").alias("m"), F.avg("x").alias("a")).first()
    assert r.m == r.a


def _rate_limit_brute(rows, limit, span):
    out = {}
    by_key = {}
    for key, ts, eid in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        kept = by_key.setdefault(key, [])
        kept[:] = [t for t in kept if t > ts - span]
        ok = len(kept) < limit
        if ok:
            kept.append(ts)
        out[eid] = ok
    return out


@pytest.mark.parametrize("chunk,files,per_batch", [(7, 1, 1), (10_000, 6, 2)])
def test_rate_limiter_depends_on_event_order_only(spark, chunk, files, per_batch):
    """One hot key and a few small ones, rows in random order over files and
    chunks: equal to a plain replay in time order."""
    import random
    from fathom.streaming import in_order
    rnd = random.Random(3)
    rows = [(0 if rnd.random() < 0.7 else rnd.randrange(1, 6), 1_700_000_000 + rnd.randrange(4000), i) for i in range(900)]
    df = spark.createDataFrame(rows, "key long, s long, id long").select(
        "key", "id", F.timestamp_seconds("s").alias("event_time"), F.lit(1).alias("present"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", chunk)
        got = in_order.replayed(df, in_order.RateLimit(5, 60_000_000), files, per_batch, "2 days")
        allowed = {r.id: r.allowed for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert allowed == _rate_limit_brute([(k, s, e) for k, s, e in rows], 5, 60)


def test_update_mode_counts_every_event_over_several_files(spark, tmp_path):
    from fathom.streaming import monitor as S
    df = spark.range(600).select(F.timestamp_seconds(1_700_000_000 + F.col("id") * 40).alias("ts"),
                                 (F.col("id") % 3).cast("string").alias("kind"))
    df.repartitionByRange(4, "ts").write.parquet(str(tmp_path / "in"))
    s = S.event_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    got = S.run_available_now(S.counters(s, "kind", watermark="1 day"), "c", ["w", "kind"])
    assert got.agg(F.sum("n")).first()[0] == 600
    assert got.groupBy("w", "kind").count().filter("count > 1").count() == 0


def test_incremental_fit_keeps_one_state_per_epoch(spark, tmp_path):
    from fathom.streaming import monitor as S
    for i in range(4):
        spark.range(25).select((F.col("id") + 25 * i).cast("double").alias("x")).withColumn(
            "y", 3 + 2 * F.col("x")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("x double, y double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    S.incremental_fit(s, "x", "y", str(tmp_path / "out")).awaitTermination()
    st = {r.epoch: r.n for r in spark.read.parquet(str(tmp_path / "out/stats")).collect()}
    assert st == {0: 25, 1: 50, 2: 75, 3: 100}
    log = spark.read.parquet(str(tmp_path / "out/log")).collect()
    assert sorted(r.epoch for r in log) == [1, 2, 3] and all(r.rmse < 1e-6 and r.n_batch == 25 for r in log)


def test_one_hot_pools_rare_levels_and_ignores_unknown(spark):
    from fathom.operators import learned
    fit = spark.createDataFrame([(v,) for v in "aaabbbc"] + [(None,)], "k string")
    new = spark.createDataFrame([(v,) for v in "abcz"] + [(None,)], "k string")
    got = {r.k: tuple(r)[1:] for r in learned.apply_one_hot(new, learned.fit_one_hot(fit, "k", 2), "k").collect()}
    assert got == {"a": (1, 0, 0), "b": (0, 1, 0), "c": (0, 0, 1), "z": (0, 0, 0), None: (0, 0, 0)}
    assert learned.fit_one_hot(fit, "k", 1, "first")[1] == ["b", "c"]
    assert learned.fit_one_hot(fit.where("k < 'c'"), "k", 1, "if_binary")[1] == ["b"]
    assert learned.fit_one_hot(fit, "k", 1, "if_binary")[1] == ["a", "b", "c"]
    with pytest.raises(ValueError):
        learned.fit_one_hot(fit, "k", max_levels=2)


def test_json_report_cleans_nested_floats(spark, tmp_path):
    from fathom.sources import tables
    df = spark.range(1).select(F.struct(F.lit(float("nan")).alias("a"), F.lit(1.5).alias("b")).alias("s"),
                               F.array(F.lit(float("inf")), F.lit(2.0)).alias("v"),
                               F.create_map(F.lit("k"), F.lit(float("-inf"))).alias("m"))
    tables.write_json_report(df, str(tmp_path / "r"))
    text = "".join(p.read_text() for p in (tmp_path / "r").glob("part-*"))
    assert "NaN" not in text and "Infinity" not in text and '"b":1.5' in text


def test_table_path_override_by_environment(spark, tmp_path, monkeypatch):
    from fathom.sources import tables
    spark.range(3).write.parquet(str(tmp_path / "mine"))
    monkeypatch.setenv("FATHOM_TABLE_ORDERS", str(tmp_path / "mine"))
    assert tables.Tables(spark, "/nowhere").orders.count() == 3


def test_group_mean_cv_equals_refits(spark):
    """Sufficient statistics against refitting the group means fold by fold."""
    import random
    from fathom.operators import stattests
    rnd = random.Random(1)
    rows = [(rnd.choice("abc"), 1e6 + rnd.random() * 100, i % 3) for i in range(120)] + [("only", 5.0, 1)]
    got = {(r.model, r.fold, r.split): r.rmse for r in stattests.oof_group_mean_scores(
        spark.createDataFrame(rows, "k string, y double, f int"), "y", "f", 3, {"g": F.col("k"), "mean": None}).collect()}
    for model in ("g", "mean"):
        for i in range(3):
            train = [(k if model == "g" else "", y) for k, y, f in rows if f != i]
            every = sum(y for _, y in train) / len(train)
            for split in ("test", "train"):
                err = []
                for k, y, f in rows:
                    if (f == i) == (split == "test"):
                        own = [v for kk, v in train if kk == (k if model == "g" else "")]
                        err.append((y - (sum(own) / len(own) if own else every)) ** 2)
                assert got[(model, i, split)] == pytest.approx((sum(err) / len(err)) ** 0.5, rel=1e-6)


def test_mice_is_ten_rounds_of_bayesian_ridge(spark):
    import numpy as np
    from fathom.operators import kernels, ml
    rnd = np.random.default_rng(4)
    a = rnd.normal(size=60)
    x = np.stack([a, a + .1 * rnd.normal(size=60), 2 * a + .1 * rnd.normal(size=60)], axis=1)
    miss = rnd.random(x.shape) < .3
    data = [(i, *[None if m else float(v) for v, m in zip(r, q)]) for i, (r, q) in enumerate(zip(x, miss))]
    got = kernels.mice(df(spark, data, "k int, a double, b double, c double"), ["a", "b", "c"]).orderBy("k").collect()
    cur = x.copy()
    for j in range(3):
        cur[miss[:, j], j] = np.median(x[~miss[:, j], j])
    for _ in range(10):
        for j in range(3):
            seen, rest = ~miss[:, j], [o for o in range(3) if o != j]
            one = np.column_stack([np.ones(seen.sum()), cur[np.ix_(seen, rest)]])
            y = cur[seen, j]
            fit = ml.bayesian_ridge({"n": float(seen.sum()), "xx": one.T @ one, "xy": (one.T @ y)[:, None], "yy": np.array([y @ y])})
            cur[~seen, j] = fit["intercept"] + cur[np.ix_(~seen, rest)] @ fit["coef"]
    assert np.allclose([[r.a, r.b, r.c] for r in got], cur, rtol=1e-7, atol=1e-9)


def test_quantile_regression_has_the_five_quantiles(spark):
    from fathom.plans.models import quantile_regression
    from tests.conftest import SF_SMALL
    rows = quantile_regression(spark, SF_SMALL).orderBy("quantile").collect()
    assert [r.quantile for r in rows] == [0.1, 0.25, 0.5, 0.75, 0.9]
    at = [r.intercept + 25 * r.slope for r in rows]
    assert at == sorted(at) and all(r.pinball > 0 for r in rows)


def test_mapped_grams_give_the_ridge_of_the_mapped_rows(spark):
    """Raw, Fourier and Nystroem maps, one pass for two groups of rows; NULLs left out."""
    import numpy as np
    from fathom.operators import kernels, ml
    rnd = np.random.default_rng(8)
    x, n = rnd.normal(size=(60, 12)), [f"x{j}" for j in range(12)]
    y = x @ rnd.normal(size=12) + 3
    rows = [(*map(float, r), float(v), "ab"[i % 2]) for i, (r, v) in enumerate(zip(x, y))] + [(None, *[0.0] * 11, 1.0, "a")]
    d = df(spark, rows, ", ".join(f"{c} double" for c in [*n, "label"]) + ", g string")
    maps = {"raw": kernels.IDENTITY, "rff": kernels.random_fourier(12, 20), "nys": kernels.nystroem(x[:15], 0.05)}
    grams = kernels.mapped_grams(d, n, "label", "g", ["a", "b"], maps)
    for name, m in maps.items():
        z = m.apply(x[::2])
        one = np.column_stack([np.ones(30), z])
        beta = np.linalg.solve(one.T @ one + 5.0 * np.diag([0.0] + [1.0] * z.shape[1]), one.T @ y[::2])
        g = grams[name, "a"]
        got = ml.ridge_solve({"xx": g[:-1, :-1], "xy": g[:-1, -1:]}, 5.0)
        assert got == pytest.approx(beta, rel=1e-8, abs=1e-9)
        other = np.column_stack([np.ones(30), m.apply(x[1::2]), y[1::2]])
        assert grams[name, "b"] == pytest.approx(other.T @ other, rel=1e-9, abs=1e-9)
    kernel = np.exp(-0.05 * ((x[:15, None] - x[None, :15]) ** 2).sum(-1))
    z = maps["nys"].apply(x[:15])
    assert z @ z.T == pytest.approx(kernel, abs=1e-6)          # exact at the landmarks
