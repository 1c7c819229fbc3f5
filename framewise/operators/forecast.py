"""Forecasts from an AR model on the differenced series.

Model (per series): ``w_t = (1 - B)(1 - B^s) y_t`` (first and seasonal difference) and
``w_t = c + phi_1 w_(t-1) + ... + phi_p w_(t-p) + e_t``, fitted by least squares from the
Gram sums of ``stats.ols``. Python only solves one p x p system per series.

* ``one_step``: at every point the prediction from the actual history,
  ``y_hat_t = y_(t-1) + y_(t-s) - y_(t-s-1) + c + sum phi_i w_(t-i)``, with a band of
  ``+- z * sigma``.
* ``dynamic``: from a cut-off on, forecasts are fed back instead of actual values. For
  p = 1 every step has a closed form (geometric sums of phi), so no row depends on the
  row before it: the forecast rows are spread over tasks like any other rows. The band
  widens with the psi-weights of ``1 / ((1 - phi B)(1 - B)(1 - B^s))``, whose squares
  need one (skew-safe) running sum per series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.operators import blocked as B
from framewise.operators import stats as M
from framewise.session import cut_lineage


def _on(by: Sequence[str], left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join per series; with no series key the right side is one row (broadcast)."""
    return left.join(right, list(by), how) if by else left.join(F.broadcast(right), how=how)


def differenced(df: DataFrame, value: str, order: Sequence, by: Sequence[str] = (), p: int = 1,
                season: int = 12, keep_position: str | None = None) -> DataFrame:
    """Add ``_y1, _ys, _ys1`` (lags 1, s, s+1 of the value), ``w`` and its lags ``wL1..wLp``,
    all as lags of the value in one ordered-window pass (``w_(t-k)`` needs lags k..k+s+1)."""
    s = season
    lag = lambda w, k: F.col(value) if k == 0 else F.lag(value, k).over(w)
    wk = lambda w, k: lag(w, k) - lag(w, k + 1) - lag(w, k + s) + lag(w, k + s + 1)

    def build(w):
        return {"_y1": lag(w, 1), "_ys": lag(w, s), "_ys1": lag(w, s + 1), "w": wk(w, 0),
                **{f"wL{k}": wk(w, k) for k in range(1, p + 1)}}
    return B.ordered_window(df, by, order, p + s + 1, 0, build, keep_position=keep_position)


def fit_ar(x: DataFrame, by: Sequence[str] = (), p: int = 1) -> DataFrame:
    """One row per series: ``c``, ``phi1..phip``, ``sigma`` (residual std, n - p - 1 dof), ``nobs``."""
    by = list(by)
    xs = [f"wL{k}" for k in range(1, p + 1)]
    long = M.ols(x, "w", xs, by)
    names = {"Intercept": "c", **{f"wL{k}": f"phi{k}" for k in range(1, p + 1)}}
    wide = long.groupBy(*by).agg(*[F.max(F.when(F.col("term") == t, F.col("coef"))).alias(n) for t, n in names.items()],
                                 F.max("rss").alias("_rss"), F.max("nobs").alias("nobs"))
    return wide.withColumn("sigma", F.sqrt(F.col("_rss") / (F.col("nobs") - (p + 1)))).drop("_rss")


def one_step(df: DataFrame, value: str, order: Sequence, by: Sequence[str] = (), p: int = 1, season: int = 12,
             z: float = 1.96) -> DataFrame:
    """One-step-ahead prediction at every point that has ``p + s + 1`` earlier points:
    (by..., order..., value, predicted, lower, upper)."""
    by = list(by)
    x = differenced(df, value, order, by, p, season)
    fit = fit_ar(x, by, p)
    j = _on(by, x, fit)
    pred_w = F.col("c")
    for k in range(1, p + 1):
        pred_w = pred_w + F.col(f"phi{k}") * F.col(f"wL{k}")
    pred = F.col("_y1") + F.col("_ys") - F.col("_ys1") + pred_w
    j = j.withColumn("predicted", pred).filter(F.col("predicted").isNotNull())
    return j.select(*df.columns, "predicted", (F.col("predicted") - z * F.col("sigma")).alias("lower"),
                    (F.col("predicted") + z * F.col("sigma")).alias("upper"))


def _geo(a: Column, n: Column) -> Column:
    """sum_{m=0..n-1} a^m."""
    return F.when(a == 1.0, n.cast("double")).otherwise((1 - F.pow(a, n)) / F.when(a == 1.0, 1.0).otherwise(1 - a))


def dynamic(df: DataFrame, value: str, order: Sequence, cutoff: Column, by: Sequence[str] = (), season: int = 12,
            z: float = 1.96) -> DataFrame:
    """Dynamic forecast (AR(1) on w) for every point where ``cutoff`` is true and all later
    points; only values before the first such point are used.

    With T the last point before the cut-off and h = 1, 2, ... steps after it, write
    ``h = r + q s`` (1 <= r <= s), the chain ``h_m = r + m s`` (m = 0..q, n = q + 1 points) and
    ``A(h) = sum_m sum_{i<h_m} phi^i = (n - phi^r G(phi^s, n)) / (1 - phi)`` with
    ``G(a, n) = sum_{m<n} a^m``. Feeding the forecasts back gives, in closed form,
    ``y_hat_(T+h) = y_(T+r-s) + n u_T + w_T phi A + c (sum_m h_m - phi A) / (1 - phi)``
    (``u_T = y_T - y_(T-s)``; for phi = 1 the sums of h_m and h_m^2 replace the geometric ones).
    ``A(h)`` is also the psi-weight ``psi_(h-1)``, so the variance is
    ``sigma^2 sum_{h'<=h} A(h')^2``: one skew-safe running sum per series.
    Output: (by..., order..., value, h, predicted, lower, upper).
    """
    by = list(by)
    s = season
    # Cut the lineage: the lagged series feeds the fit, the state, the anchors and the
    # forecast rows; it is written once below the shared checkpoint folder.
    x = cut_lineage(differenced(df, value, order, by, 1, s, keep_position="_pos"), "forecast-lags")
    fit = fit_ar(x, by, 1).select(*by, "c", F.col("phi1").alias("phi"), "sigma")
    pos = x.withColumn("_after", F.coalesce(cutoff, F.lit(False)))
    first = pos.filter("_after").groupBy(*by).agg((F.min("_pos") - 1).alias("_T"))
    pos = _on(by, pos, first)
    state = pos.filter(F.col("_pos") == F.col("_T")).select(
        *by, F.col("w").alias("_wT"), (F.col(value) - F.col("_ys")).alias("_uT"))
    anchors = pos.filter((F.col("_pos") > F.col("_T") - s) & (F.col("_pos") <= F.col("_T"))).select(
        *by, (F.col("_pos") - F.col("_T") + s).cast("bigint").alias("_r"), F.col(value).cast("double").alias("_anchor"))
    fut = pos.filter(F.col("_pos") > F.col("_T")).withColumn("h", (F.col("_pos") - F.col("_T")).cast("bigint"))
    fut = _on(by, _on(by, fut, state), fit)
    phi, c, h = F.col("phi"), F.col("c"), F.col("h")
    r = F.pmod(h - 1, F.lit(s)) + 1
    q = F.floor((h - r) / s)
    n = q + 1
    one = phi == 1.0
    den = F.when(one, 1.0).otherwise(1 - phi)
    h1 = n * r + s * q * n / 2.0                                        # sum_m h_m
    h2 = n * r * r + r * s * q * n + s * s * q * n * (2 * q + 1) / 6.0  # sum_m h_m^2
    A = F.when(one, h1).otherwise((n - F.pow(phi, r) * _geo(F.pow(phi, F.lit(s)), n)) / den)
    wsum = F.when(one, F.col("_wT") * h1 + c * (h2 + h1) / 2).otherwise(F.col("_wT") * phi * A + c * (h1 - phi * A) / den)
    fut = fut.withColumns({"_r": r.cast("bigint"), "_pred": n * F.col("_uT") + wsum, "_psi2": A * A})
    fut = B.running(fut, by, ["h"], "_psi2", ["sum"], fmt="_v")
    fut = fut.join(anchors, [*by, "_r"], "inner")
    pred = F.col("_anchor") + F.col("_pred")
    half = z * F.col("sigma") * F.sqrt(F.col("_v"))
    return fut.select(*df.columns, "h", pred.alias("predicted"), (pred - half).alias("lower"), (pred + half).alias("upper"))
