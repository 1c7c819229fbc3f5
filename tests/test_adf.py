"""The unit-root test's sums against numpy's least squares, and series without an answer."""

import math
import time

import numpy as np
import pandas as pd
import pytest

from framewise.operators import stats as M


def brute(x, maxlag=None):
    n, dx = len(x), np.diff(x)
    maxlag = min(int(math.ceil(12 * (n / 100) ** 0.25)) if maxlag is None else maxlag, n // 2 - 2)

    def fit(lags, p):
        t = np.arange(p + 1, n)
        X = np.column_stack([np.ones(len(t)), x[t - 1] - x.mean(), *[dx[t - 1 - j] for j in range(1, lags + 1)]])
        b, *_ = np.linalg.lstsq(X, dx[t - 1], rcond=None)
        return X, b, ((dx[t - 1] - X @ b) ** 2).sum()
    aic = []
    for lags in range(maxlag + 1):
        X, _, rss = fit(lags, maxlag)
        aic.append(len(X) * (math.log(2 * math.pi) + math.log(rss / len(X)) + 1) + 2 * X.shape[1])
    used = int(np.argmin(aic))
    X, b, rss = fit(used, used)
    se = math.sqrt(np.linalg.inv(X.T @ X)[1, 1] * rss / (len(X) - X.shape[1]))
    return b[1] / se, used, len(X), min(aic)


def frame(spark, series):
    rows = [(k, t, float(v)) for k, x in series.items() for t, v in enumerate(x)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["k", "t", "y"]))


def check(r, x, maxlag=None):
    stat, used, nobs, aic = brute(np.asarray(x, float), maxlag)
    assert (r["usedlag"], r["nobs"]) == (used, nobs)
    assert r["adf"] == pytest.approx(stat, rel=1e-6) and r["icbest"] == pytest.approx(aic, rel=1e-8)


def test_sums_as_least_squares(spark):
    rng = np.random.default_rng(7)
    e = rng.normal(size=900)
    series = {"noise": e[:200], "walk": np.cumsum(e), "far": 1e6 + np.cumsum(e[:300]), "short": e[:14], "tiny": 1e-9 * e[:120],
              "ar3": np.array([0.0] * 3 + [0.0] * 400)}
    for t in range(3, 403):
        series["ar3"][t] = 0.5 * series["ar3"][t - 1] - 0.4 * series["ar3"][t - 3] + e[t]
    for rows in (100_000, 40):
        got = {r["k"]: r for r in M.adf_test(frame(spark, series), "y", ["t"], by=["k"], block_rows=rows).collect()}
        for k, x in series.items():
            check(got[k], x)


def test_series_without_an_answer(spark):
    e = np.random.default_rng(1).normal(size=80)
    series = {"constant": np.full(60, 3.7), "line": 1e5 + 0.3 * np.arange(70), "one": [1.0], "three": [1.0, 2.0, 4.0],
              "wave": np.cos(np.arange(90) * math.pi / 2), "good": np.cumsum(e)}
    got = {r["k"]: r for r in M.adf_test(frame(spark, series), "y", ["t"], by=["k"]).collect()}
    assert got.keys() == series.keys()
    for k in ("constant", "line", "one", "three", "wave"):
        assert all(got[k][c] is None for c in ("adf", "pvalue", "usedlag", "icbest")), k
        assert got[k]["nobs"] == len(series[k]) - 1
    check(got["good"], series["good"])
    assert M.adf_test(frame(spark, series).limit(0), "y", ["t"]).count() == 0


def test_null_key_and_values(spark):
    e = np.cumsum(np.random.default_rng(2).normal(size=60))
    rows = [(None, t, float(v)) for t, v in enumerate(e)] + [("a", t, None if t % 7 == 3 else float(v)) for t, v in enumerate(e)]
    got = {r["k"]: r for r in M.adf_test(spark.createDataFrame(rows, "k string, t int, y double"), "y", ["t"], by=["k"]).collect()}
    check(got[None], e)
    check(got["a"], [v for t, v in enumerate(e) if t % 7 != 3])


def test_many_lags_plan_in_seconds(spark):
    x = np.cumsum(np.random.default_rng(3).normal(size=1500))
    began = time.time()
    r = M.adf_test(frame(spark, {"x": x}), "y", ["t"], maxlag=200).first()
    assert time.time() - began < 60
    check(r, x, 200)
