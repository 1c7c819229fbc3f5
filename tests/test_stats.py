"""Models against closed forms and numpy."""

import numpy as np
import pandas as pd

from framewise.operators import stats as M


def test_ols_recovers_ar1(spark):
    x = np.zeros(200)
    for t in range(1, 200):
        x[t] = 0.7 * x[t - 1] + np.sin(t * 1.7)  # fixed recurrence, no randomness
    pdf = pd.DataFrame({"t": range(1, 200), "y": x[1:], "l1": x[:-1]})
    got = M.ols(spark.createDataFrame(pdf), "y", ["l1"]).toPandas().set_index("term")
    A = np.column_stack([np.ones(199), pdf.l1])
    b = np.linalg.lstsq(A, pdf.y, rcond=None)[0]
    np.testing.assert_allclose(got.loc[["Intercept", "l1"], "coef"].values, b, rtol=1e-9)


def test_exact_trend_has_zero_residuals(spark):
    pdf = pd.DataFrame({"t": np.arange(50, dtype=float), "y": 3.0 + 2.0 * np.arange(50)})
    r = M.trend_residuals(spark.createDataFrame(pdf), "y", "t").toPandas()
    assert np.abs(r.resid).max() < 1e-9


def test_acf_and_pacf(spark):
    rng = np.random.default_rng(3)
    e = rng.normal(size=400)
    df = spark.createDataFrame(pd.DataFrame({"t": np.arange(400), "e": e}))
    a = M.acf(df, "e", ["t"], nlags=5).toPandas().sort_values("lag")
    d = e - e.mean()
    exp = [np.sum(d[k:] * d[:len(d) - k]) / np.sum(d * d) for k in range(6)]
    np.testing.assert_allclose(a.acf.values, exp, rtol=1e-9)
    p = M.pacf_from_acf(spark.createDataFrame(a)).toPandas().sort_values("lag")
    ref = [1.0] + [np.linalg.solve(np.array([[exp[abs(i - j)] for j in range(k)] for i in range(k)]),
                                   np.array(exp[1:k + 1]))[-1] for k in range(1, 6)]
    np.testing.assert_allclose(p.pacf.values, ref, rtol=1e-9)


def test_seasonal_decompose_matches_manual(spark):
    n = 60
    t = np.arange(n)
    y = 10 + 0.3 * t + 2 * np.sin(2 * np.pi * t / 12) + np.cos(t)
    got = M.seasonal_decompose(spark.createDataFrame(pd.DataFrame({"t": t, "y": y})), "y", ["t"], period=12)
    got = got.toPandas().sort_values("t")
    w = np.r_[0.5, np.ones(11), 0.5] / 12
    trend = np.full(n, np.nan)
    trend[6:n - 6] = np.convolve(y, w, mode="valid")
    det = y - trend
    pm = np.array([np.nanmean(det[i::12]) for i in range(12)])
    pm -= pm.mean()
    np.testing.assert_allclose(got.trend.values, trend, rtol=1e-9, equal_nan=True)
    np.testing.assert_allclose(got.seasonal.values, pm[t % 12], rtol=1e-9, atol=1e-12)
