"""Factor-model active weights against dense algebra."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.operators import factor_weights as FW

K = [f"f{i}" for i in range(5)]


def dense(x, f, s, alpha, beta, both, target):
    sigma = x @ f @ x.T + np.diag(s * s)
    a = np.column_stack([np.ones(len(s)), beta] if both else [np.ones(len(s))])
    inv = np.linalg.inv(sigma)
    nu = np.linalg.solve(a.T @ inv @ a, a.T @ inv @ alpha)
    w = inv @ (alpha - a @ nu)
    return w * target / np.sqrt(w @ sigma @ w), sigma, a


@pytest.mark.parametrize("cells", [FW.CELLS, 100])
def test_against_dense_algebra(spark, monkeypatch, cells):
    monkeypatch.setattr(FW, "CELLS", cells)
    rng = np.random.default_rng(3)
    panel, exposures, cov, want = [], [], [], {}
    for t, (name, n) in enumerate([("momentum", 40), ("beta", 25), ("momentum", 7), ("beta", 2), ("beta", 1)]):
        day = dt.date(2020, 1, 1 + t)
        x, root = rng.normal(size=(n, 5)), rng.normal(size=(5, 3)) * 0.1  # a covariance of rank 3
        f = root @ root.T
        if t == 1:
            f = np.zeros((5, 5))  # a day without covariances
        s, alpha, beta = rng.uniform(0.1, 0.4, n), rng.normal(size=n) * 0.01, rng.uniform(0.5, 1.5, n)
        x[0] = 0  # an asset without exposures
        both = name == "momentum"
        if n > 1 + both:
            w, sigma, a = dense(x, f, s, alpha, beta, both, 0.05)
            want[day] = (w, sigma, a)
        for i in range(n):
            panel.append((name, day, f"a{i}", float(alpha[i]), float(beta[i]), float(s[i])))
            if i:
                exposures.append((day, f"a{i}", *map(float, x[i])))
        cov += [(day, K[i], *map(float, f[i])) for i in range(5) if t != 1] + [(day, "unknown", *[9.0] * 5)]
    panel += [("momentum", dt.date(2020, 1, 1), "none", None, 1.0, 0.2), ("momentum", dt.date(2020, 1, 1), "flat", 0.1, 1.0, 0.0)]
    cols = ", ".join(f"{k} double" for k in K)
    df = spark.createDataFrame(panel, "signal_name string, date date, barrid string, alpha double, predicted_beta double, specific_risk double").repartition(4)
    out = FW.factor_active_weights(df, spark.createDataFrame(exposures, f"date date, barrid string, {cols}"),
                                   spark.createDataFrame(cov, f"date date, factor string, {cols}"), K, ("signal_name", "date"), F.col("signal_name") == "momentum").collect()
    assert len(out) == len(panel)
    got = {(r["date"], r["barrid"]): r["weight"] for r in out}
    assert got[dt.date(2020, 1, 1), "none"] is None and got[dt.date(2020, 1, 1), "flat"] is None
    assert got[dt.date(2020, 1, 5), "a0"] == 0.0
    for day, (w, sigma, a) in want.items():
        mine = np.array([got[day, f"a{i}"] for i in range(len(w))])
        assert mine == pytest.approx(w, rel=1e-8, abs=1e-12)
        assert a.T @ mine == pytest.approx(np.zeros(a.shape[1]), abs=1e-10) and np.sqrt(mine @ sigma @ mine) == pytest.approx(0.05)
