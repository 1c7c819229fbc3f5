"""Statistics and time-series models.

Data-sized work is Spark: lag columns (skew-safe blocked windows), one aggregation of the
Gram sums X'X, X'y, y'y per series, lag products for autocorrelation. Python sees only
one small row per series (a p x p system or a lag array) -- never the series itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewise.operators import blocked as B
from framewise.operators.ordering import with_positions
from framewise.session import cut_lineage


def _kschema(df: DataFrame, by: Sequence[str]) -> str:
    f = {x.name: x.dataType.simpleString() for x in df.schema.fields}
    return "".join(f"`{b}` {f[b]}, " for b in by)


def gram(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str] = (), intercept: bool = True) -> tuple[DataFrame, list[str]]:
    """One aggregation per series: n, sums of x_i x_j (i <= j), x_i y and y y over the rows
    where y and every x are non-NULL."""
    terms = (["Intercept"] if intercept else []) + list(xs)
    cols = {"Intercept": F.lit(1.0)} | {x: F.col(x).cast("double") for x in xs}
    ok = F.col(y).isNotNull()
    for x in xs:
        ok = ok & F.col(x).isNotNull()
    d = df.filter(ok)
    aggs = [F.count(F.lit(1)).alias("_n"), F.sum(F.col(y).cast("double") ** 2).alias("_yy")]
    for i, a in enumerate(terms):
        aggs.append(F.sum(cols[a] * F.col(y)).alias(f"_xy{i}"))
        for j in range(i, len(terms)):
            aggs.append(F.sum(cols[a] * cols[terms[j]]).alias(f"_xx{i}_{j}"))
    g = d.groupBy(*by).agg(*aggs) if by else d.agg(*aggs)
    return g, terms


def _solve(row: pd.Series, p: int):
    xtx = np.empty((p, p))
    for i in range(p):
        for j in range(i, p):
            xtx[i, j] = xtx[j, i] = row[f"_xx{i}_{j}"]
    xty = np.array([row[f"_xy{i}"] for i in range(p)])
    n, yy = float(row["_n"]), float(row["_yy"])
    b = np.linalg.lstsq(xtx, xty, rcond=None)[0]
    rss = max(yy - 2 * b @ xty + b @ xtx @ b, 0.0)
    dof = n - p
    sigma2 = rss / dof if dof > 0 else float("nan")
    try:
        cov = sigma2 * np.linalg.inv(xtx)
        se = np.sqrt(np.clip(np.diag(cov), 0, None))
    except np.linalg.LinAlgError:
        se = np.full(p, np.nan)
    return b, se, n, rss


def centred_gram(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One aggregation per series of the rows where y and every x are non-NULL: n, means, and sums of
    products of deviations from the means. Spark merges co-moments around running means, so
    regressors far from zero lose no digits."""
    d = df.filter(F.col(y).isNotNull())
    for x in xs:
        d = d.filter(F.col(x).isNotNull())
    c = [F.col(x).cast("double") for x in (*xs, y)]
    aggs = [F.count(F.lit(1)).alias("_n"), *[F.avg(x).alias(f"_m{i}") for i, x in enumerate(c)]]
    aggs += [(F.covar_pop(c[i], c[j]) * F.count(F.lit(1))).alias(f"_s{i}_{j}") for i in range(len(c)) for j in range(i, len(c))]
    return d.groupBy(*by).agg(*aggs) if by else d.agg(*aggs)


def _solve_centred(row: pd.Series, p: int):
    """Fit with intercept from centred sums, each regressor scaled to unit length."""
    s = np.zeros((p + 1, p + 1))
    for i in range(p + 1):
        for j in range(i, p + 1):
            s[i, j] = s[j, i] = row[f"_s{i}_{j}"]
    n, mean = float(row["_n"]), np.array([row[f"_m{i}"] for i in range(p + 1)])
    scale = np.sqrt(np.where(np.diag(s)[:p] > 0, np.diag(s)[:p], 1.0))
    unit = s[:p, :p] / np.outer(scale, scale)
    b = np.linalg.lstsq(unit, s[:p, p] / scale, rcond=None)[0] / scale
    rss = max(s[p, p] - 2 * b @ s[:p, p] + b @ s[:p, :p] @ b, 0.0)
    dof = n - p - 1
    sigma2 = rss / dof if dof > 0 else float("nan")
    try:
        inv = np.linalg.inv(unit) / np.outer(scale, scale)
        var = sigma2 * np.array([1 / n + mean[:p] @ inv @ mean[:p], *np.diag(inv)])
        se = np.sqrt(np.clip(var, 0, None))
    except np.linalg.LinAlgError:
        se = np.full(p + 1, np.nan)
    return np.array([mean[p] - b @ mean[:p], *b]), se, n, rss


def ols(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str] = (), intercept: bool = True) -> DataFrame:
    """``ols("y ~ x1 + x2 ...")``: coefficients and standard errors per series, long form
    (by..., term, coef, std_err, nobs, rss)."""
    by = list(by)
    if intercept:
        g, terms = centred_gram(df, y, xs, by), ["Intercept", *xs]
    else:
        g, terms = gram(df, y, xs, by, intercept)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bt in batches:
            out = []
            for _, row in bt.iterrows():  # one row per series
                if not row["_n"]:
                    continue
                b, se, n, rss = _solve_centred(row, len(xs)) if intercept else _solve(row, len(terms))
                for t, name in enumerate(terms):
                    out.append({**{k: row[k] for k in by}, "term": name, "coef": float(b[t]),
                                "std_err": None if math.isnan(se[t]) else float(se[t]), "nobs": int(n), "rss": float(rss)})
            yield pd.DataFrame(out, columns=[*by, "term", "coef", "std_err", "nobs", "rss"])

    return g.mapInPandas(solve, _kschema(g, by) + "term string, coef double, std_err double, nobs long, rss double")


def trend_residuals(df: DataFrame, y: str, t: str, by: Sequence[str] = (), name: str = "resid") -> DataFrame:
    """``y ~ trend`` fitted per series with ``regr_slope``/``regr_intercept`` (one
    aggregation), residual column joined back."""
    by = list(by)
    fit = (df.groupBy(*by) if by else df.groupBy()).agg(F.regr_slope(y, t).alias("_b"), F.regr_intercept(y, t).alias("_a"))
    j = df.join(fit, by, "left") if by else df.join(F.broadcast(fit), how="inner")
    return j.withColumn(name, F.col(y) - (F.col("_a") + F.col("_b") * F.col(t))).drop("_a", "_b")


def acf(df: DataFrame, value: str, order: Sequence, by: Sequence[str] = (), nlags: int = 36) -> DataFrame:
    """Autocorrelation at lags 0..nlags: sum_t e_t e_(t-k) / sum_t e_t^2 with e demeaned per
    series (the unadjusted estimator). Lag columns come from skew-safe blocked windows;
    all lags are summed in one aggregation."""
    by = list(by)
    mu = (df.groupBy(*by) if by else df.groupBy()).agg(F.avg(value).alias("_mu"))
    e = (df.join(mu, by, "left") if by else df.join(F.broadcast(mu), how="inner")).withColumn(
        "_e", F.col(value) - F.col("_mu")).drop("_mu")
    lagged = B.lags(e, by, order, "_e", range(nlags + 1), fmt="_e{k}")
    aggs = [F.sum(F.col("_e0") * F.col(f"_e{k}")).alias(f"_s{k}") for k in range(nlags + 1)]
    s = lagged.groupBy(*by).agg(*aggs) if by else lagged.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(k).alias("lag"), (F.col(f"_s{k}") / F.col("_s0")).alias("acf"))
                    for k in range(nlags + 1)])
    return s.select(*by, F.explode(arr).alias("_r")).select(*by, F.col("_r.lag").cast("bigint").alias("lag"), "_r.acf")


def pacf_from_acf(acf_df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Partial autocorrelation by the Durbin-Levinson recursion over each series' ACF
    (a bounded array of nlags+1 numbers per series)."""
    by = list(by)
    arrays = (acf_df.groupBy(*by) if by else acf_df.groupBy()).agg(
        F.sort_array(F.collect_list(F.struct("lag", "acf"))).alias("_a"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bt in batches:
            out = []
            for _, row in bt.iterrows():
                r = [float(s["acf"]) for s in row["_a"]]
                for k, v in enumerate(durbin_levinson(r)):
                    out.append({**{b: row[b] for b in by}, "lag": k, "pacf": v})
            yield pd.DataFrame(out, columns=[*by, "lag", "pacf"])

    return arrays.mapInPandas(run, _kschema(arrays, by) + "lag long, pacf double")


def durbin_levinson(r: Sequence[float]) -> list[float]:
    """PACF values 0..K from autocorrelations r_0..r_K."""
    K = len(r) - 1
    out = [1.0]
    phi = np.zeros(K + 1)
    for k in range(1, K + 1):
        prev = phi.copy()
        num = r[k] - sum(prev[j] * r[k - j] for j in range(1, k))
        den = 1.0 - sum(prev[j] * r[j] for j in range(1, k))
        phi_kk = num / den if den != 0 else float("nan")
        phi[k] = phi_kk
        for j in range(1, k):
            phi[j] = prev[j] - phi_kk * prev[k - j]
        out.append(float(phi_kk))
    return out


def seasonal_decompose(df: DataFrame, value: str, order: Sequence, by: Sequence[str] = (), period: int = 12) -> DataFrame:
    """Additive decomposition: centred moving average trend (2 x period for even periods,
    half weights at both ends), seasonal = per-position mean of the detrended series,
    centred to sum to zero, resid = value - trend - seasonal. NULL trend at the ends."""
    by = list(by)
    h = period // 2
    even = period % 2 == 0

    def build(w):
        frame = w.rowsBetween(-h, h)
        full = F.count(F.col(value)).over(frame) == (2 * h + 1)
        s = F.sum(F.col(value)).over(frame)
        if even:
            s = s - 0.5 * F.lag(value, h).over(w) - 0.5 * F.lead(value, h).over(w)
        return {"trend": F.when(full, s / period)}
    t = B.ordered_window(df, by, order, h, h, build, keep_position="_fw_pos")
    t = t.withColumn("_fw_phase", F.pmod(F.col("_fw_pos"), F.lit(period))).withColumn(
        "_fw_detr", F.col(value) - F.col("trend"))
    phase = t.groupBy(*by, "_fw_phase").agg(F.avg("_fw_detr").alias("_fw_pm"))
    wc = Window.partitionBy(*by)
    phase = phase.withColumn("seasonal", F.col("_fw_pm") - F.avg("_fw_pm").over(wc)).drop("_fw_pm")
    j = t.join(phase, [*by, "_fw_phase"], "left")
    return j.withColumn("resid", F.col(value) - F.col("trend") - F.col("seasonal")).select(
        *df.columns, "trend", "seasonal", "resid")


# ---------------------------------------------------------------- augmented Dickey-Fuller
# Fixed values (regression with a constant, one variable):
# MacKinnon (1994) p-value response surface -- upper and lower limits of the statistic,
# the switch point, and the normal-quantile polynomials below / above it (increasing powers);
# MacKinnon (2010) finite-sample critical values tau_inf + b1/T + b2/T^2 + b3/T^3.
ADF_TAU_MAX = 2.74
ADF_TAU_MIN = -18.83
ADF_TAU_STAR = -1.61
ADF_SMALL_P = (2.1659, 1.4412, 0.038269)
ADF_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_CRIT = (("1%", (-3.43035, -6.5393, -16.786, -79.433)),
            ("5%", (-2.86154, -2.8903, -4.234, -40.040)),
            ("10%", (-2.56677, -1.5384, -2.809, 0.0)))


def adf_pvalue(stat: float) -> float:
    """Approximate p-value of the Dickey-Fuller statistic (constant, one variable)."""
    if math.isnan(stat):
        return float("nan")
    if stat > ADF_TAU_MAX:
        return 1.0
    if stat < ADF_TAU_MIN:
        return 0.0
    coef = ADF_SMALL_P if stat <= ADF_TAU_STAR else ADF_LARGE_P
    zq = sum(c * stat ** i for i, c in enumerate(coef))
    return 0.5 * (1.0 + math.erf(zq / math.sqrt(2.0)))


def adf_critical(nobs: int) -> dict[str, float]:
    return {k: b[0] + b[1] / nobs + b[2] / nobs ** 2 + b[3] / nobs ** 3 for k, b in ADF_CRIT}


class AdfSums:
    """Gram sums of the test's regressions on any leading lags and any first row, from sums over a whole series and its ends.

    With l the centred levels, numbered from 0, and e_t = l_t - l_(t-1): ``c[k]`` = sum e_t e_(t-k) and ``b[k]`` = sum l_(t-1) e_(t-k)
    over all t > k, ``s1`` and ``s2`` the sums of l_(t-1) and its square over t > 0. A regression on the rows t > p with L <= p lags needs
    sums over fewer rows; the rest lies within p rows of either end, given by ``head`` (l_0, l_1, ...) and ``tail`` (l_(n-1), l_(n-2), ...)."""

    def __init__(self, n: int, c: np.ndarray, b: np.ndarray, s1: float, s2: float, head: np.ndarray, tail: np.ndarray):
        self.n, self.c, self.b, self.s1, self.s2, self.head, self.tail = n, c, b, s1, s2, head, tail
        m = len(c)
        e = np.zeros(m + 1)
        have = np.diff(head)[:m]
        e[1:len(have) + 1] = have
        back = np.zeros(2 * m)
        have = (tail[:-1] - tail[1:])[:m]
        back[:len(have)] = have
        # at [k, x]: what the first x rows, or the last x, add to c[k] and b[k]
        self.first, self.last, self.first_b = (np.zeros((m, m + 1)) for _ in range(3))
        for k in range(m):
            if k + 1 <= m:
                self.first[k, k + 1:] = np.cumsum(e[k + 1:] * e[1:m + 1 - k])
                self.first_b[k, k + 1:] = np.cumsum(self._padded(head, m)[k:m] * e[1:m + 1 - k])
            self.last[k, 1:] = np.cumsum(back[:m] * back[k:k + m])

    @staticmethod
    def _padded(x: np.ndarray, size: int) -> np.ndarray:
        return np.concatenate([x[:size], np.zeros(max(0, size - len(x)))])

    def gram(self, p: int, lags: int) -> tuple[np.ndarray, np.ndarray, float, int]:
        """(X'X, X'y, y'y, rows) for the regressors 1, l_(t-1), e_(t-1), ..., e_(t-lags) of e_t, rows t = p + 1, ..., n - 1."""
        rows = self.n - 1 - p
        i, j = np.triu_indices(lags + 1)
        k = j - i
        a = np.zeros((lags + 1, lags + 1))
        a[i, j] = self.c[k] - self.first[k, p - i] - self.last[k, i]
        a = np.triu(a) + np.triu(a, 1).T
        at = np.arange(lags + 1)
        cross = self.b[at] - self.first_b[at, p]
        total = self.tail[at] - self.head[p - at]
        x = np.zeros((lags + 2, lags + 2))
        x[0, 0], x[0, 1], x[1, 1] = rows, self.s1 - self.head[:p].sum(), self.s2 - (self.head[:p] ** 2).sum()
        x[0, 2:], x[1, 2:] = total[1:], cross[1:]
        x[2:, 2:] = a[1:, 1:]
        x = np.triu(x) + np.triu(x, 1).T
        return x, np.concatenate([[total[0], cross[0]], a[0, 1:]]), a[0, 0], rows


#: A pivot below this share of its regressor's square sum says that the regressor depends on those before it; a residual below this
#: share of the target's variation is a perfect fit.
ADF_RANK, ADF_FIT = 1e-11, 1e-13


def nested_fits(xtx: np.ndarray, xty: np.ndarray, yy: float) -> list[float]:
    """Residual sum of squares on the first 1, 2, ... regressors, from one Cholesky factor; ends before the first that
    depends on those before it."""
    size = len(xtx)
    r, z, left, out = np.zeros((size, size)), np.zeros(size), yy, []
    for i in range(size):
        pivot = xtx[i, i] - r[:i, i] @ r[:i, i]
        if not pivot > ADF_RANK * xtx[i, i]:
            break
        r[i, i] = math.sqrt(pivot)
        r[i, i + 1:] = (xtx[i, i + 1:] - r[:i, i] @ r[:i, i + 1:]) / r[i, i]
        z[i] = (xty[i] - r[:i, i] @ z[:i]) / r[i, i]
        left -= z[i] ** 2
        out.append(left)
    return out


def adf_of(sums: AdfSums, maxlag: int) -> tuple[float, int, int, float] | None:
    """(statistic, lags, rows, AIC), the lags by AIC on common rows; None where no regression has an answer: a series that is
    constant, that a constant step or its own lags explain without a residual, or that is too short."""
    if maxlag < 0:
        return None
    xtx, xty, yy, n = sums.gram(maxlag, maxlag)
    rss = nested_fits(xtx, xty, yy)
    if len(rss) < 2 or not rss[0] > ADF_FIT * yy:
        return None
    best = None
    for lags, left in enumerate(rss[1:]):
        if not left > ADF_FIT * rss[0]:
            return None
        aic = n * (math.log(2 * math.pi) + math.log(left / n) + 1) + 2 * (lags + 2)
        if best is None or aic < best[0]:
            best = (aic, lags)
    aic, lags = best
    xtx, xty, yy, n = sums.gram(lags, lags)
    rss = nested_fits(xtx, xty, yy)
    if len(rss) < lags + 2 or n <= lags + 2 or not rss[-1] > ADF_FIT * rss[0]:
        return None
    inverse = np.linalg.inv(xtx)
    se = math.sqrt(max(inverse[1, 1], 0.0) * rss[-1] / (n - lags - 2))
    return (float(inverse[1] @ xty) / se, lags, n, aic) if se > 0 else None


def _adf_block(lags: int, by: list[str]):
    """Sums of one block of a series, whose first rows repeat the block before (``home`` false)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        level = pdf["_lvl"].to_numpy(np.float64)
        start = int((~pdf["_fw_home"].to_numpy(bool)).sum())
        e = np.diff(level, prepend=level[:1])
        c, b = np.zeros(lags + 1), np.zeros(lags + 1)
        for k in range(min(lags + 1, len(level) - 1)):
            lo = max(start, k + 1)
            c[k] = e[lo:] @ e[lo - k:len(e) - k]
            b[k] = level[lo - 1:-1] @ e[lo - k:len(e) - k]
        before = level[max(start, 1) - 1:-1]
        return pd.DataFrame({**{x: [pdf[x].iloc[0]] for x in by}, "_c": [c], "_b": [b], "_s1": [before.sum()], "_s2": [before @ before]})
    return run


def adf_test(df: DataFrame, value: str, order: Sequence, by: Sequence[str] = (), maxlag: int | None = None,
             block_rows: int = B.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant, lag chosen by AIC, per series:
    (by..., adf, pvalue, usedlag, nobs, crit_1pct, crit_5pct, crit_10pct, icbest).

    ``dy_t = a + g y_(t-1) + sum_{j<=L} d_j dy_(t-j)``; ``adf`` is the t statistic of ``g``. The default largest lag is
    ``ceil(12 (n/100)^(1/4))``, at most ``n//2 - 2``; all candidates L are compared on the rows that have all largest-lag terms, the chosen
    one is fitted on all rows it has. NULL values are left out, a NULL key is a series.

    All Gram matrices follow from K + 1 lagged products of the series with itself and the values at its ends (``AdfSums``), so rows are read once:
    blocks of ``block_rows`` rows, with the K + 1 rows before each, give K + 1 sums to add up. A series that is constant, a straight line
    or otherwise explained without a residual, or too short, gets NULL for ``adf``, ``pvalue``, ``usedlag`` and ``icbest``, and nobs
    and critical values of a regression without lags."""
    by = list(by)
    known = df.filter(F.col(value).isNotNull())
    sizes = (known.groupBy(*by) if by else known.groupBy()).agg(F.count(F.col(value)).alias("_n"), F.avg(value).alias("_mu"))
    ml = F.ceil(12.0 * F.pow(F.col("_n") / 100.0, 0.25)) if maxlag is None else F.lit(maxlag)
    sizes = cut_lineage(sizes.withColumn("_ml", F.least(ml, F.floor(F.col("_n") / 2) - 2).cast("int")).where("_n > 0"), "adf-sizes")
    K = max(int(sizes.agg(F.max("_ml")).first()[0] or 0), 0)  # one number

    named = sizes.select(*[F.col(k).alias(f"_fw_s{i}") for i, k in enumerate(by)], "_n", "_mu", "_ml")
    on = F.lit(True)
    for i, k in enumerate(by):
        on = on & F.col(k).eqNullSafe(F.col(f"_fw_s{i}"))
    x = with_positions(known.select(*by, *order, value), order, by, name="_pos")
    x = x.join(named, on) if by else x.join(F.broadcast(named))
    # with a constant in the model the level may be centred: sums of squares far from zero lose digits
    x = cut_lineage(x.select(*by, "_pos", "_n", "_ml", (F.col(value) - F.col("_mu")).alias("_lvl")), "adf-levels")
    rows = max(block_rows, K + 2)
    blocks = B.with_halo(x.select(*by, "_pos", "_lvl"), "_pos", rows, K + 1, 0)
    kept = ", ".join(f"`{k}` {x.schema[k].dataType.simpleString()}" for k in by)
    kept = kept + ", " if kept else ""
    summed = blocks.groupBy(*by, "_fw_blk").applyInPandas(_adf_block(K, by), kept + "_c array<double>, _b array<double>, _s1 double, _s2 double")
    per_lag = (summed.select(*by, "_s1", "_s2", F.posexplode(F.arrays_zip("_c", "_b")).alias("_lag", "_x"))
               .groupBy(*by, "_lag").agg(F.sum("_x._c").alias("_c"), F.sum("_x._b").alias("_b"), F.sum("_s1").alias("_s1"), F.sum("_s2").alias("_s2")))
    sums = per_lag.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_lag", "_c", "_b"))).alias("_lagged"), F.max("_s1").alias("_s1"), F.max("_s2").alias("_s2"))
    near = (F.col("_pos") <= K + 1) | (F.col("_pos") >= F.col("_n") - K - 2)
    ends = x.where(near).groupBy(*by).agg(F.first("_n").alias("_n"), F.first("_ml").alias("_ml"),
                                          F.sort_array(F.collect_list(F.struct("_pos", "_lvl"))).alias("_ends"))
    sums = sums.select(*[F.col(k).alias(f"_fw_s{i}") for i, k in enumerate(by)], "_lagged", "_s1", "_s2")
    ready = ends.join(sums, on) if by else ends.join(F.broadcast(sums))
    out = ["adf", "pvalue", "usedlag", "nobs", "crit_1pct", "crit_5pct", "crit_10pct", "icbest"]

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bt in batches:
            done = []
            for _, row in bt.iterrows():
                n, at = int(row["_n"]), {int(s["_pos"]): float(s["_lvl"]) for s in row["_ends"]}
                head = np.array([at[i] for i in range(min(n, K + 2))])
                tail = np.array([at[n - 1 - i] for i in range(min(n, K + 2))])
                c, b = (np.array([float(s[f]) for s in row["_lagged"]]) for f in ("_c", "_b"))
                fit = adf_of(AdfSums(n, c, b, float(row["_s1"]), float(row["_s2"]), head, tail), int(row["_ml"]))
                stat, used, nobs, aic = fit or (None, None, max(n - 1, 0), None)
                crit = adf_critical(nobs) if nobs else dict.fromkeys(("1%", "5%", "10%"))
                done.append({**{k: row[k] for k in by}, "adf": stat, "pvalue": None if stat is None else adf_pvalue(stat), "usedlag": used, "nobs": nobs,
                             "crit_1pct": crit["1%"], "crit_5pct": crit["5%"], "crit_10pct": crit["10%"], "icbest": aic})
            yield pd.DataFrame(done, columns=[*by, *out], dtype=object)

    return ready.where("_n IS NOT NULL").select(*by, "_n", "_ml", "_ends", "_lagged", "_s1", "_s2").mapInPandas(
        finish, kept + "adf double, pvalue double, usedlag long, nobs long, crit_1pct double, crit_5pct double, crit_10pct double, icbest double")
