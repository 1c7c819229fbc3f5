"""Skew-safe ordering primitives against pandas brute force, with a hot key and blocks
small enough that every frame crosses block boundaries."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from framewise.operators import blocked as B
from framewise.operators.aggregates import group_mode, group_first, quantiles
from framewise.operators.ewm import ewm_mean
from framewise.operators.ordering import positional_rows, with_positions


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 3000
    key = np.where(rng.random(n) < 0.6, 0, rng.integers(1, 20, n))  # key 0 holds ~60% of rows
    pdf = pd.DataFrame({"k": key, "t": rng.permutation(n), "v": rng.normal(size=n).round(3)})
    pdf.loc[rng.choice(n, 40, replace=False), "v"] = np.nan
    df = spark.createDataFrame(pdf.astype({"k": "int64", "t": "int64"}).replace({np.nan: None}),
                               "k long, t long, v double")
    return pdf.sort_values(["k", "t"]).reset_index(drop=True), df


def test_positions_match_row_number(skewed):
    pdf, df = skewed
    got = with_positions(df, ["t"], ["k"], name="pos", size_name="n", partitions=7).toPandas()
    got = got.sort_values(["k", "t"]).reset_index(drop=True)
    assert (got.pos.values == pdf.groupby("k").cumcount().values).all()
    assert (got.n.values == pdf.groupby("k").t.transform("size").values).all()


def test_positions_global_and_iloc(skewed):
    pdf, df = skewed
    got = positional_rows(df, ["t"], 5, -3).toPandas().sort_values("t")
    exp = pdf.sort_values("t").iloc[5:-3]
    assert got.t.tolist() == exp.t.tolist()


def test_positions_null_group_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, 1)], "k long, t long")
    got = sorted(with_positions(df, ["t"], ["k"], name="p").collect(), key=lambda r: (r.k is not None, r.k, r.t))
    assert [(r.k, r.t, r.p) for r in got] == [(None, 1, 0), (None, 2, 1), (1, 1, 0), (1, 3, 1)]


def test_blocked_lags_rolling_running(skewed):
    pdf, df = skewed
    out = B.lags(df, ["k"], ["t"], "v", [1, 3], block_rows=50)
    out = B.rolling(out, ["k"], ["t"], "v", 4, ["sum", "mean"], block_rows=50)
    out = B.rolling(out, ["k"], ["t"], "v", 6, ["std"], center=True, fmt="c_{agg}", block_rows=50)
    out = B.running(out, ["k"], ["t"], "v", ["mean", "count"], block_rows=50)
    got = out.toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    g = pdf.groupby("k").v
    np.testing.assert_allclose(got.v_L1, g.shift(1), equal_nan=True)
    np.testing.assert_allclose(got.v_L3, g.shift(3), equal_nan=True)
    np.testing.assert_allclose(got.v_sum4, g.transform(lambda s: s.rolling(4).sum()), equal_nan=True)
    np.testing.assert_allclose(got.v_mean4, g.transform(lambda s: s.rolling(4).mean()), equal_nan=True)
    np.testing.assert_allclose(got.c_std, g.transform(lambda s: s.rolling(6, center=True).std()), rtol=1e-9, equal_nan=True)
    np.testing.assert_allclose(got.v_expanding_mean, g.transform(lambda s: s.expanding().mean()), rtol=1e-9, equal_nan=True)
    np.testing.assert_array_equal(got.v_expanding_count, g.transform(lambda s: s.expanding().count()))


def test_rolling_time_left_open(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0, 1.0), (1, t0 + dt.timedelta(days=1), 2.0), (1, t0 + dt.timedelta(days=2), 4.0),
            (1, t0 + dt.timedelta(days=2, hours=1), None), (2, t0, 10.0)]
    df = spark.createDataFrame(rows, "k long, ts timestamp, v double")
    got = {(r.k, r.ts): r.m for r in B.rolling_time(df, ["k"], "ts", "v", 2 * 86_400_000_000, ["mean"], fmt="m").collect()}
    # frame (t - 2 days, t]: the row exactly 2 days earlier is outside
    assert got[(1, t0)] == 1.0 and got[(1, t0 + dt.timedelta(days=1))] == 1.5
    assert got[(1, t0 + dt.timedelta(days=2))] == 3.0 and got[(1, t0 + dt.timedelta(days=2, hours=1))] == 3.0
    assert got[(2, t0)] == 10.0


def test_rank_average_ties(spark):
    df = spark.createDataFrame([(1, 3.0, 1), (1, 1.0, 2), (1, 1.0, 3), (1, None, 4)], "g long, v double, id long")
    got = {r.id: r.rank for r in B.rank_average(df, ["g"], "v", ["id"]).collect()}
    assert got == {1: 3.0, 2: 1.5, 3: 1.5, 4: None}


@pytest.mark.parametrize("xs,alpha,exp", [([1.0, None, 3.0], 0.5, [1.0, 1.0, 2.6]),
                                          ([0.0, 1.0, 2.0], 0.5, [0.0, 0.6666667, 1.4285714])])
def test_ewm_fixtures(spark, xs, alpha, exp):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "t long, x double")
    got = [r.e for r in ewm_mean(df, "x", ["t"], alpha=alpha, name="e").orderBy("t").collect()]
    np.testing.assert_allclose(got, exp, rtol=1e-6)


def test_ewm_many_blocks_matches_pandas(skewed):
    pdf, df = skewed
    got = ewm_mean(df, "v", ["t"], ["k"], alpha=0.3, name="e", block_rows=7).toPandas().sort_values(["k", "t"])
    exp = pdf.groupby("k").v.transform(lambda s: s.ewm(alpha=0.3).mean())
    np.testing.assert_allclose(got.e.values, exp.values, rtol=1e-9, equal_nan=True)


def test_quantiles_match_numpy(skewed):
    pdf, df = skewed
    got = quantiles(df, ["v"], [0.1, 0.5, 0.99], ["k"]).toPandas().set_index("k").sort_index()
    for q, c in [(0.1, "v_p10"), (0.5, "v_p50"), (0.99, "v_p99")]:
        exp = pdf.dropna().groupby("k").v.quantile(q)
        np.testing.assert_allclose(got[c].values, exp.values, rtol=1e-12)


def test_mode_ties_smallest_and_first_non_null(spark):
    df = spark.createDataFrame([(1, "b", 1, None), (1, "a", 2, 5.0), (1, "b", 3, 6.0), (1, "a", 4, None)],
                               "g long, s string, o long, x double")
    assert group_mode(df, ["g"], "s").collect()[0].s == "a"
    r = group_first(df, ["g"], ["x"], ["o"]).collect()[0]
    assert r.x == 5.0
    assert group_first(df, ["g"], ["x"], ["o"], last=True).collect()[0].x == 6.0


def test_previous_leading_matches_lag_with_ties_and_hot_key(spark):
    rng = np.random.default_rng(11)
    n = 2000
    team = np.where(rng.random(n) < 0.5, 0, rng.integers(1, 6, n))  # team 0 holds ~half the rows
    pdf = pd.DataFrame({"team": team.astype("float"), "day": rng.integers(0, 40, n), "id": rng.permutation(n)})
    pdf.loc[rng.choice(n, 30, replace=False), "team"] = np.nan  # NULL group key forms its own group
    exp = pdf.sort_values(["team", "day", "id"], na_position="first")
    exp["prev"] = exp.groupby("team", dropna=False)["day"].shift(1)
    df = spark.createDataFrame(pdf.astype({"day": "int64", "id": "int64"}).replace({np.nan: None}),
                               "team double, day long, id long")
    got = B.previous_leading(df, ["team"], "day", ["id"], name="prev").toPandas()
    m = exp.merge(got, on="id", suffixes=("_exp", "_got"))
    assert len(m) == n
    assert ((m["prev_exp"].isna() & m["prev_got"].isna()) | (m["prev_exp"] == m["prev_got"])).all()


def test_cut_lineage_writes_below_checkpoint_dir(spark):
    from framewise.session import cut_lineage, ensure_checkpoint_dir
    df = spark.range(100).withColumn("y", F.col("id") * 2)
    cut = cut_lineage(df, "t")
    assert cut.agg(F.sum("y")).first()[0] == 9900
    root = ensure_checkpoint_dir(spark).replace("file:", "").rstrip("/")
    assert all(root in f for f in cut.inputFiles())


def test_rolling_time_several_columns_match_pandas(spark):
    rng = np.random.default_rng(5)
    n = 600
    ts = pd.Timestamp("2020-01-01") + pd.to_timedelta(np.sort(rng.integers(0, 200 * 86400, n)), unit="s")
    pdf = pd.DataFrame({"k": rng.integers(0, 3, n), "ts": ts, "a": rng.normal(size=n), "b": rng.normal(size=n)})
    pdf.loc[rng.choice(n, 50, replace=False), "b"] = np.nan
    df = spark.createDataFrame(pdf.replace({np.nan: None}), "k long, ts timestamp_ntz, a double, b double")
    got = B.rolling_time(df, ["k"], "ts", ["a", "b"], 7 * 86_400_000_000, ["mean", "count"], fmt="{value}_{agg}").toPandas()
    exp = pdf.sort_values(["k", "ts"]).copy()
    for c in ("a", "b"):
        r = exp.groupby("k").rolling("7D", on="ts")[c]
        exp[f"{c}_mean"] = r.mean().values
        exp[f"{c}_count"] = r.count().values
    m = exp.merge(got, on=["k", "ts", "a"], suffixes=("", "_got"))
    assert len(m) == n
    for c in ("a_mean", "b_mean", "a_count", "b_count"):
        e, g = m[c].astype(float), m[f"{c}_got"].astype(float)
        assert ((e.isna() & g.isna()) | ((e - g).abs() < 1e-9)).all(), c


def test_rolling_count_follows_rows_in_frame(spark):
    import math
    xs = [1.0, None, 3.0, 4.0, None, None, None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "t long, x double")
    got = {r["t"]: r["x_count3"] for r in B.rolling(df, [], ["t"], "x", 3, ["count"]).collect()}
    exp = pd.Series([math.nan if x is None else x for x in xs]).rolling(3).count().tolist()
    assert [got[i] for i in range(len(xs))] == [None if math.isnan(e) else int(e) for e in exp]


def test_previous_leading_with_null_dates(spark):
    rng = np.random.default_rng(12)
    n = 400
    pdf = pd.DataFrame({"team": rng.integers(0, 3, n).astype("float"), "day": rng.integers(0, 15, n).astype("float"),
                        "id": rng.permutation(n)})
    pdf.loc[rng.choice(n, 25, replace=False), "day"] = np.nan  # NULL dates sort first, as in an ascending lag
    exp = pdf.sort_values(["team", "day", "id"], na_position="first")
    exp["prev"] = exp.groupby("team")["day"].shift(1)
    df = spark.createDataFrame(pdf.astype({"id": "int64"}).replace({np.nan: None}), "team double, day double, id long")
    got = B.previous_leading(df, ["team"], "day", ["id"], name="prev").toPandas()
    m = exp.merge(got, on="id", suffixes=("_exp", "_got"))
    assert len(m) == n
    assert ((m["prev_exp"].isna() & m["prev_got"].isna()) | (m["prev_exp"] == m["prev_got"])).all()
