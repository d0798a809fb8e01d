"""Propensity (L1-L4): MLlib's fit equals a Newton solution of the same L2 objective."""
import numpy as np
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shelfwise.plans import propensity as pr


def newton(X, y, lam, iters=50):
    n, d = X.shape
    Xb = np.hstack([X, np.ones((n, 1))])
    w = np.zeros(d + 1)
    reg = np.eye(d + 1) * lam
    reg[-1, -1] = 0.0
    for _ in range(iters):
        p = 1 / (1 + np.exp(-Xb @ w))
        g = Xb.T @ (p - y) / n + reg @ w
        H = (Xb.T * (p * (1 - p))) @ Xb / n + reg
        w -= np.linalg.solve(H, g)
    return w


def test_logistic_matches_newton(spark):
    rng = np.random.default_rng(3)
    tiers = ["Gold", "Platinum", "Private Client"]
    rows = []
    for i in range(300):
        t = tiers[i % 3]
        coh = bool(rng.random() < 0.3)
        units = int(rng.integers(0, 40))
        rev = float(round(rng.random() * 100, 2))
        cap = int(rng.integers(0, 5))
        n = int(rng.integers(0, 6) + (2 if coh else 0))
        rows.append((i, "R", t, coh, units, rev, cap, n))
    df = spark.createDataFrame(rows, "customer_id long, home_region string, loyalty_tier string, "
                                     "is_cohort boolean, total_units long, total_revenue double, "
                                     "capsule_units long, n_orders long")
    data = pr.with_target(df, "R")
    med = float(np.median([r[-1] for r in rows]))
    assert data.where(F.col("is_high_frequency") == 1).count() == sum(r[-1] >= med for r in rows)
    model = pr.fit_propensity(data)
    lr = model.stages[-1]
    # features: one-hot tier with 'Gold' (first alphabetically) dropped, then the numerics
    X = np.array([[t == "Private Client", t == "Platinum", c, u, rv, cp] for _, _, t, c, u, rv, cp, _ in rows], float)
    y = np.array([r[-1] >= med for r in rows], float)
    w = newton(X, y, 1.0 / len(rows))
    ours = np.append(lr.coefficients.toArray(), lr.intercept)
    labels = model.stages[0].labels
    assert labels == ["Private Client", "Platinum", "Gold"]
    assert np.allclose(ours, w, atol=1e-3), (ours, w)
    g = pr.fit_gradient(data, model).collect()
    assert len(g) == 7 and all(abs(r.gradient) < 1e-6 * max(1.0, r.scale) and r.n_rows == 300 for r in g)
    early = pr.fit_gradient(data, pr.fit_propensity(data, max_iter=1)).collect()  # stopped before the optimum
    assert any(abs(r.gradient) > 1e-3 for r in early)
    top = pr.rank_clients(data, model, 37).collect()
    assert len(top) == 37 and all(a.propensity >= b.propensity for a, b in zip(top, top[1:]))


def test_model_scores_after_an_observation(spark):
    """An Observation anywhere in the session must not break the scoring tasks."""
    rows = [(i, "R", ["Gold", "Silver"][i % 2], i % 3 == 0, i % 7, float(i % 11), i % 5, i % 4) for i in range(40)]
    df = spark.createDataFrame(rows, "customer_id long, home_region string, loyalty_tier string, is_cohort boolean, "
                                     "total_units long, total_revenue double, capsule_units long, n_orders long")
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).count()
    assert seen.get["n"] == 3
    data = pr.with_target(df, "R")
    model = pr.fit_propensity(data)
    assert pr.rank_clients(data, model, 5).count() == 5
    assert {r.n_rows for r in pr.fit_gradient(data, model).collect()} == {40}
