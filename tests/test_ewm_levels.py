"""EWM with blocks of blocks against pandas, and the size of its plan."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from framewise.operators import ewm


@pytest.mark.parametrize("alpha,block_rows", [(1e-8, None), (1e-8, 5), (0.001, 4), (0.03, 3), (0.5, 2), (0.999, None)])
def test_ewm_levels_as_in_pandas(spark, alpha, block_rows):
    rng = np.random.default_rng(5)
    n = 400
    pdf = pd.DataFrame({"t": np.arange(n), "k": np.where(rng.random(n) < 0.7, "hot", "b"), "x": 100 + rng.normal(size=n)})
    pdf.loc[rng.random(n) < 0.2, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    got = {r["t"]: r["e"] for r in ewm.ewm_mean(df, "x", ["t"], ["k"], alpha=alpha, name="e", block_rows=block_rows).collect()}
    for _, g in pdf.groupby("k"):
        want = g.x.ewm(alpha=alpha).mean()
        for t, w in zip(g.t, want, strict=True):
            assert (got[t] is None) == np.isnan(w) and (got[t] is None or got[t] == pytest.approx(w, rel=1e-9)), (t, got[t], w)


def test_small_alphas_keep_the_plan_small(spark):
    df = spark.range(100).select("id", F.col("id").cast("double").alias("x"))
    plans = [len(ewm.ewm_mean(df, "x", ["id"], alpha=a, name="e")._jdf.queryExecution().analyzed().toString()) for a in (1e-3, 1e-8, 1e-12)]
    assert max(plans) < 60_000
    assert ewm.ewm_mean(df, "x", ["id"], alpha=1e-12, name="e").where("id = 99").first()["e"] == pytest.approx(49.5)
    assert ewm.ewm_mean(df.limit(0), "x", ["id"], alpha=0.1).count() == 0
