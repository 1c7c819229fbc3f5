"""Kernel density against numpy, and what its plan shuffles."""

import numpy as np
import pytest

from framewise.operators import plotdata as V


def test_kde_as_in_numpy(spark):
    x = np.concatenate([np.random.default_rng(4).normal(1e4, 3, 400), [1e4] * 50])
    got = V.kde(spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double"), "v", 32).orderBy("point").collect()
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 32)
    want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert [r["point"] for r in got] == list(range(32))
    assert [r["x"] for r in got] == pytest.approx(grid) and [r["density"] for r in got] == pytest.approx(want, rel=1e-9)


def test_kde_moves_sums_alone(spark):
    df = spark.range(1000).selectExpr("cast(id as double) AS v")
    plan = V.kde(df, "v")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    assert V.kde(df.limit(0), "v").count() == 0
    assert {r["density"] for r in V.kde(df.selectExpr("2D AS v"), "v", 4).collect()} == {None}
