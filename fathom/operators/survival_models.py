"""Iterative survival models (V6 Cox PH, V10 Tobit): each Newton step is
one distributed pass; only the (d+1) x (d+1) system reaches the driver."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.functions.special import norm_sf, sql_norm_cdf
from fathom.operators.ordered import running_totals


def _lin(cols: Sequence[str], beta: np.ndarray, intercept: float = 0.0) -> Column:
    e = F.lit(float(intercept))
    for c, b in zip(cols, beta):
        e = e + F.lit(float(b)) * F.col(c)
    return e


def cox_ph(df: DataFrame, duration: str, event: str, covariates: Sequence[str], penalizer: float = 0.1,
           max_iter: int = 20, tol: float = 1e-8) -> dict:
    """Cox proportional hazards with Breslow ties and an L2 penalty
    0.5 * penalizer * ||beta||^2, by Newton-Raphson.  Per step: per-time
    sums of w = exp(x'beta), w x and w x x' (one aggregate), risk-set sums
    as reverse running sums over distinct times (``running_totals``), then
    one aggregate for log-likelihood, gradient and Hessian."""
    cov = list(covariates)
    d = len(cov)
    x = df.select(F.col(duration).alias("t"), F.col(event).cast("double").alias("e"),
                  *[F.col(c).cast("double").alias(c) for c in cov]).cache()
    beta = np.zeros(d)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    loglik = None
    for _ in range(max_iter):
        eta = _lin(cov, beta)
        w = F.exp(eta)
        per_t = x.groupBy("t").agg(
            F.sum("e").alias("dt"), F.sum(F.col("e") * eta).alias("se_eta"),
            *[F.sum(F.col("e") * F.col(c)).alias(f"sx_{c}") for c in cov],
            F.sum(w).alias("w0"), *[F.sum(w * F.col(c)).alias(f"w1_{c}") for c in cov],
            *[F.sum(w * F.col(cov[i]) * F.col(cov[j])).alias(f"w2_{i}_{j}") for i, j in pairs])
        sums = {"r0": F.col("w0"), **{f"r1_{c}": F.col(f"w1_{c}") for c in cov},
                **{f"r2_{i}_{j}": F.col(f"w2_{i}_{j}") for i, j in pairs}}
        risk = running_totals(per_t.withColumn("__nt", -F.col("t")), ["__nt"], sums).where(F.col("dt") > 0)
        m1 = {c: F.col(f"r1_{c}") / F.col("r0") for c in cov}
        agg = risk.agg(
            F.sum(F.col("se_eta") - F.col("dt") * F.log("r0")).alias("ll"),
            *[F.sum(F.col(f"sx_{c}") - F.col("dt") * m1[c]).alias(f"g_{c}") for c in cov],
            *[F.sum(F.col("dt") * (F.col(f"r2_{i}_{j}") / F.col("r0") - m1[cov[i]] * m1[cov[j]])).alias(f"h_{i}_{j}")
              for i, j in pairs]).first()
        ll = agg["ll"] - 0.5 * penalizer * float(beta @ beta)
        g = np.array([agg[f"g_{c}"] for c in cov]) - penalizer * beta
        info = np.zeros((d, d))
        for i, j in pairs:
            info[i, j] = info[j, i] = agg[f"h_{i}_{j}"]
        info += penalizer * np.eye(d)
        step = np.linalg.solve(info, g)
        beta = beta + step
        converged = loglik is not None and abs(ll - loglik) < tol * (1 + abs(ll))
        loglik = ll
        if converged or np.max(np.abs(step)) < 1e-9:
            break
    x.unpersist()
    se = np.sqrt(np.diag(np.linalg.inv(info)))
    z = beta / se
    return {"coef": beta, "se": se, "z": z, "p": [2 * norm_sf(abs(v)) for v in z], "loglik": loglik,
            "covariates": cov}


def cox_baseline(df: DataFrame, duration: str, event: str, covariates: Sequence[str], beta: np.ndarray) -> DataFrame:
    """Breslow baseline cumulative hazard and survival per distinct event time."""
    w = F.exp(_lin(covariates, beta))
    per_t = df.groupBy(F.col(duration).alias("t")).agg(F.sum(F.col(event).cast("double")).alias("dt"), F.sum(w).alias("w0"))
    r = running_totals(per_t.withColumn("__nt", -F.col("t")), ["__nt"], {"r0": F.col("w0")}).where(F.col("dt") > 0)
    h = running_totals(r.select("t", (F.col("dt") / F.col("r0")).alias("inc")), ["t"], {"H0": F.col("inc")})
    return h.select("t", "H0", F.exp(-F.col("H0")).alias("S0"))


def tobit(df: DataFrame, y: str, censored: str, covariates: Sequence[str], max_iter: int = 30,
          tol: float = 1e-8) -> dict:
    """Right-censored normal regression (Tobit) by Newton steps on
    (intercept, beta, log sigma).  The gradient is analytic; the Hessian is
    a forward difference of the gradient, with all d + 2 gradient
    evaluations computed in the same single aggregate per step.  The upper
    tail uses the Zelen-Severo form, so the inverse Mills ratio stays
    finite far in the tail.  Starts from least squares."""
    cov = list(covariates)
    x = df.select(F.col(y).cast("double").alias("__y"), F.col(censored).cast("int").alias("__c"),
                  *[F.col(c).cast("double").alias(c) for c in cov]).cache()
    from fathom.operators.ml import gram, ridge_solve
    g0 = gram(x, cov, ["__y"])
    b = ridge_solve(g0, 0.0)
    resid = float(np.sqrt(max((g0["yy"][0] - 2 * b @ g0["xy"][:, 0] + b @ g0["xx"] @ b) / g0["n"], 1e-12)))
    theta = np.concatenate([b, [np.log(resid)]])
    p = len(theta)
    h = 1e-5

    def grad_exprs(th, tag):
        mu = _lin(cov, th[1:-1], th[0])
        sigma = float(np.exp(th[-1]))
        z = (F.col("__y") - mu) / F.lit(sigma)
        zcol = f"__z{tag}"
        # inverse Mills ratio phi(z) / (1 - Phi(z)), stable in the upper tail
        tail = F.expr(f"1.0e0 - {sql_norm_cdf(zcol)}")
        phi = F.exp(-0.5 * F.col(zcol) * F.col(zcol)) / F.lit(np.sqrt(2 * np.pi))
        mills = phi / F.greatest(tail, F.lit(1e-300))
        unc = F.col("__c") == 0
        gb = F.when(unc, F.col(zcol) / sigma).otherwise(mills / sigma)
        gs = F.when(unc, F.col(zcol) * F.col(zcol) - 1).otherwise(mills * F.col(zcol))
        feats = [F.lit(1.0)] + [F.col(c) for c in cov]
        ll = F.when(unc, -0.5 * F.col(zcol) * F.col(zcol) - F.lit(np.log(sigma) + 0.5 * np.log(2 * np.pi))) \
            .otherwise(F.log(F.greatest(tail, F.lit(1e-300))))
        return z.alias(zcol), [F.sum(gb * f).alias(f"g{tag}_{k}") for k, f in enumerate(feats)] + \
            [F.sum(gs).alias(f"g{tag}_{p - 1}"), F.sum(ll).alias(f"ll{tag}")]

    ll_prev = None
    for _ in range(max_iter):
        thetas = [theta] + [theta + h * np.eye(p)[k] for k in range(p)]
        zs, aggs = [], []
        for t, th in enumerate(thetas):
            zc, ex = grad_exprs(th, t)
            zs.append(zc)
            aggs += ex
        row = x.select("*", *zs).agg(*aggs).first()
        g = np.array([row[f"g0_{k}"] for k in range(p)])
        hess = np.column_stack([(np.array([row[f"g{t}_{k}"] for k in range(p)]) - g) / h for t in range(1, p + 1)])
        hess = 0.5 * (hess + hess.T)
        try:
            step = np.linalg.solve(-hess, g)
        except np.linalg.LinAlgError:
            step = 0.01 * g
        theta = theta + step
        ll = row["ll0"]
        if ll_prev is not None and abs(ll - ll_prev) < tol * (1 + abs(ll)):
            break
        ll_prev = ll
    x.unpersist()
    return {"intercept": float(theta[0]), "coef": theta[1:-1], "sigma": float(np.exp(theta[-1])), "loglik": ll_prev,
            "ols": b, "ols_sigma": resid}
