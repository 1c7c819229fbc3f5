"""ADF and forecasts against brute force on small fixture series (numpy, step by step)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewise.operators import forecast as FC
from framewise.operators import stats as M


def _series(n, phi, seed, trend=0.0, season=0.0):
    rng = np.random.default_rng(seed)
    y = np.zeros(n)
    for t in range(1, n):
        y[t] = phi * y[t - 1] + rng.normal() + trend * t + season * math.sin(2 * math.pi * t / 12)
    return y


def _frame(spark, series: dict):
    rows = [(k, int(t), float(v)) for k, ys in series.items() for t, v in enumerate(ys)]
    return spark.createDataFrame(rows, "k string, t long, y double")


def _ols(X, y):
    b, *_ = np.linalg.lstsq(X, y, rcond=None)
    r = y - X @ b
    rss = float(r @ r)
    se = np.sqrt(np.diag(np.linalg.inv(X.T @ X)) * rss / (len(y) - X.shape[1]))
    return b, se, rss


def _adf_brute(x):
    """Constant-only ADF with the AIC lag search, written from the textbook recipe."""
    n = len(x)
    maxlag = min(int(math.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)
    dx = np.diff(x)

    def design(L, first):  # rows t = first..n-1 (index into x)
        rows = range(first, n)
        X = [[1.0, x[t - 1], *[dx[t - 1 - j] for j in range(1, L + 1)]] for t in rows]
        return np.array(X), np.array([dx[t - 1] for t in rows])

    best = None
    for L in range(maxlag + 1):
        X, y = design(L, maxlag + 1)
        _, _, rss = _ols(X, y)
        aic = len(y) * (math.log(2 * math.pi) + math.log(rss / len(y)) + 1) + 2 * X.shape[1]
        if best is None or aic < best[0]:
            best = (aic, L)
    X, y = design(best[1], best[1] + 1)
    b, se, _ = _ols(X, y)
    return b[1] / se[1], best[1], len(y), best[0]


def test_adf_pvalue_hits_the_critical_levels():
    for stat, p in [(-3.43035, 0.01), (-2.86154, 0.05), (-2.56677, 0.10)]:
        assert M.adf_pvalue(stat) == pytest.approx(p, abs=5e-4)
    assert M.adf_pvalue(-30.0) == 0.0 and M.adf_pvalue(5.0) == 1.0
    lo, hi = M.adf_pvalue(M.ADF_TAU_STAR - 1e-9), M.adf_pvalue(M.ADF_TAU_STAR + 1e-9)
    assert lo == pytest.approx(hi, abs=2e-3)


def test_adf_matches_brute_force(spark):
    series = {"ar": _series(150, 0.6, 1), "walk": np.cumsum(np.random.default_rng(2).normal(size=90)),
              "seasonal": _series(120, 0.3, 3, season=2.0)}
    got = {r["k"]: r for r in M.adf_test(_frame(spark, series), "y", ["t"], by=["k"]).collect()}
    for k, x in series.items():
        stat, lag, nobs, ic = _adf_brute(x)
        assert got[k]["usedlag"] == lag and got[k]["nobs"] == nobs, k
        assert got[k]["adf"] == pytest.approx(stat, rel=1e-7), k
        assert got[k]["icbest"] == pytest.approx(ic, rel=1e-9), k
        assert got[k]["crit_5pct"] == pytest.approx(-2.86154 - 2.8903 / nobs - 4.234 / nobs ** 2 - 40.04 / nobs ** 3)


def _fit_brute(y, s=12):
    w = np.array([y[t] - y[t - 1] - y[t - s] + y[t - s - 1] for t in range(s + 1, len(y))])
    X = np.column_stack([np.ones(len(w) - 1), w[:-1]])
    b, _, rss = _ols(X, w[1:])
    return b[0], b[1], math.sqrt(rss / (len(w) - 1 - 2))


def test_one_step_matches_brute_force(spark):
    y = _series(60, 0.5, 5, season=3.0)
    c, phi, sigma = _fit_brute(y)
    got = {r["t"]: r for r in FC.one_step(_frame(spark, {"a": y}), "y", ["t"], by=["k"]).collect()}
    assert sorted(got) == list(range(14, 60))
    for t, r in got.items():
        w1 = y[t - 1] - y[t - 2] - y[t - 13] + y[t - 14]
        pred = y[t - 1] + y[t - 12] - y[t - 13] + c + phi * w1
        assert r["predicted"] == pytest.approx(pred, rel=1e-8)
        assert r["upper"] - r["lower"] == pytest.approx(2 * 1.96 * sigma, rel=1e-8)


def test_dynamic_matches_recursion(spark):
    s, cut = 12, 50
    series = {"a": _series(80, 0.5, 7, season=3.0), "b": _series(75, 0.98, 8, trend=0.01)}
    df = _frame(spark, series)
    got = {(r["k"], r["t"]): r for r in FC.dynamic(df, "y", ["t"], FC.F.col("t") >= cut, by=["k"], season=s).collect()}
    for k, y in series.items():
        c, phi, sigma = _fit_brute(y, s)
        T = cut - 1
        yh = list(y[:T + 1])
        w_prev = y[T] - y[T - 1] - y[T - s] + y[T - s - 1]
        psi = {}
        for h in range(1, len(y) - T):
            w_hat = c + phi * w_prev
            yh.append(yh[-1] + yh[-s] - yh[-s - 1] + w_hat)
            w_prev = w_hat
            # psi weights of 1 / ((1 - phi B)(1 - B)(1 - B^s)) by recursion
            j = h - 1
            psi[j] = (1.0 if j == 0 else 0.0) + phi * psi.get(j - 1, 0.0) + psi.get(j - 1, 0.0) - phi * psi.get(j - 2, 0.0) \
                + psi.get(j - s, 0.0) - phi * psi.get(j - s - 1, 0.0) - psi.get(j - s - 1, 0.0) + phi * psi.get(j - s - 2, 0.0)
            var = sigma ** 2 * sum(psi[i] ** 2 for i in range(h))
            r = got[(k, T + h)]
            assert r["h"] == h
            assert r["predicted"] == pytest.approx(yh[-1], rel=1e-7, abs=1e-7), (k, h)
            assert (r["upper"] - r["predicted"]) == pytest.approx(1.96 * math.sqrt(var), rel=1e-7), (k, h)
        assert sum(1 for kk, _ in got if kk == k) == len(y) - T - 1


def test_forest_grid_search_learns_a_separable_rule(spark):
    from framewise.operators.models import forest_grid_search
    rows = [(int(i % 10 >= 5), "ab"[i % 2], None if i % 7 == 0 else float(i % 10)) for i in range(400)]
    df = spark.createDataFrame(rows, "y int, g string, x double")
    got = forest_grid_search(df, "y", ["g"], ["x"], max_depth=[1, 3], min_leaf=[1], folds=2, num_trees=5).collect()
    assert len(got) == 2 and {r["param_max_depth"] for r in got} == {1, 3}
    # x >= 5 decides y; rows with x imputed by the median (4.5 -> 5 side) cost a few points
    assert max(r["mean_test_score"] for r in got) > 0.85


def test_registered_forest_search_runs_the_default_grid(spark, monkeypatch):
    from types import SimpleNamespace

    from pyspark.ml.tuning import CrossValidator

    from framewise.plans import registry
    folds = []

    def fit(self, data):
        folds.append(self.getNumFolds())
        return SimpleNamespace(avgMetrics=[0.5] * len(self.getEstimatorParamMaps()), stdMetrics=[0.0] * len(self.getEstimatorParamMaps()))

    monkeypatch.setattr(CrossValidator, "fit", fit)
    got = registry.queries()["forest_grid_search"](spark, "/root/testdata/sf0.001").collect()
    assert sorted((r["param_max_depth"], r["param_min_samples_leaf"]) for r in got) == [(d, m) for d in (1, 2, 5, 10, 20, 30) for m in (2, 3, 5)]
    assert folds == [5]


def test_forest_fits_get_tasks_by_rows_not_by_pieces_of_the_input(spark, monkeypatch):
    from types import SimpleNamespace

    from pyspark.ml.tuning import CrossValidator

    from framewise.operators.models import forest_grid_search
    seen = []

    def fit(self, data):
        seen.append((data.count(), data.rdd.getNumPartitions(), self.getEstimator().getCacheNodeIds()))
        return SimpleNamespace(avgMetrics=[0.5], stdMetrics=[0.0])

    monkeypatch.setattr(CrossValidator, "fit", fit)
    df = spark.range(400).select((F.col("id") % 2).alias("y"), F.lit("a").alias("g"), F.col("id").alias("x")).repartition(24)
    forest_grid_search(df, "y", ["g"], ["x"], max_depth=[1], min_leaf=[1], folds=2, num_trees=5)
    assert seen == [(400, 1, True)]


def test_one_step_ar2_matches_brute_force(spark):
    y = _series(70, 0.4, 9, season=2.0)
    s = 12
    w = {t: y[t] - y[t - 1] - y[t - s] + y[t - s - 1] for t in range(s + 1, len(y))}
    ts = [t for t in w if t - 2 in w]
    X = np.array([[1.0, w[t - 1], w[t - 2]] for t in ts])
    b, _, rss = _ols(X, np.array([w[t] for t in ts]))
    sigma = math.sqrt(rss / (len(ts) - 3))
    got = {r["t"]: r for r in FC.one_step(_frame(spark, {"a": y}), "y", ["t"], by=["k"], p=2).collect()}
    assert sorted(got) == ts
    for t in ts:
        pred = y[t - 1] + y[t - s] - y[t - s - 1] + b[0] + b[1] * w[t - 1] + b[2] * w[t - 2]
        assert got[t]["predicted"] == pytest.approx(pred, rel=1e-8)
        assert got[t]["upper"] - got[t]["predicted"] == pytest.approx(1.96 * sigma, rel=1e-8)
