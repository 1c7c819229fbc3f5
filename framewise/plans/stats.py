"""M-rows: statistics and time-series models on the monthly order series.

The series: orders per day, then the mean of the daily counts per month (only observed
days enter a month's mean), ordered by month.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.functions.numeric import stable_round, stable_round_sql
from framewise.operators import blocked as B
from framewise.operators import forecast as FC
from framewise.operators import stats as M
from framewise.operators.ordering import with_positions
from framewise.plans.registry import register
from framewise.sources.tables import table

_MONTHLY_SQL = """
daily AS (SELECT o_orderdate AS day, count(*) AS n FROM orders GROUP BY 1),
y AS (SELECT date_trunc('month', day) AS month, avg(n) AS y FROM daily GROUP BY 1),
p AS (SELECT month, y, row_number() OVER (ORDER BY month) - 1 AS trend FROM y)"""


def monthly_series(spark, d):
    o = table(spark, d, "orders", ["o_orderdate"])
    daily = o.groupBy(F.col("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return daily.groupBy(F.date_trunc("month", "day").alias("month")).agg(F.avg("n").alias("y"))


def _with_trend(spark, d):
    return with_positions(monthly_series(spark, d), ["month"], name="trend")


def _ols_sql(p: int) -> str:
    """Least squares in SQL for the oracle: Gram sums, then Gauss-Jordan elimination of
    [X'X | X'y | I] as a recursive CTE over a p x (2p + 1) list matrix; residuals are
    summed from the data. Expects a CTE ``x(y, x0..x{p-1})``."""
    ij = lambda i, j: f"s{min(i, j)}_{max(i, j)}"
    sums = ", ".join([f"sum(x{i} * x{j}) AS s{i}_{j}" for i in range(p) for j in range(i, p)]
                     + [f"sum(x{i} * y) AS b{i}" for i in range(p)])
    rows = ", ".join("[" + ", ".join([ij(i, j) for j in range(p)] + [f"b{i}"] + ["1.0" if j == i else "0.0" for j in range(p)])
                     + "]" for i in range(p))
    coefs = ", ".join(f"mm[{i + 1}][{p + 1}] AS c{i}" for i in range(p))
    fitted = " + ".join(f"c{i} * x{i}" for i in range(p))
    return f""",
g AS (SELECT {sums} FROM x),
ge(i, mm) AS (SELECT 0, [{rows}]::DOUBLE[][] FROM g
  UNION ALL SELECT i + 1, list_transform(mm, lambda rw, r: CASE WHEN r = i + 1 THEN list_transform(rw, lambda v: v / rw[i + 1])
      ELSE list_transform(rw, lambda v, cc: v - rw[i + 1] * mm[i + 1][cc] / mm[i + 1][i + 1]) END) FROM ge WHERE i < {p}),
fin AS (SELECT mm FROM ge WHERE i = {p}),
cf AS (SELECT {coefs} FROM fin),
rs AS (SELECT sum((y - ({fitted})) * (y - ({fitted}))) AS rss, count(*) AS n FROM x, cf),
t AS (SELECT unnest(generate_series(1, {p})) AS t)"""


_OLS_TERMS = ["Intercept", "trend", "L1", "L2", "L3", "L4", "L5"]


@register("ols_lagged", sql="WITH RECURSIVE" + _MONTHLY_SQL + """,
l AS (SELECT month, y, """ + ", ".join(f"lag(y, {k}) OVER (ORDER BY month) AS L{k}" for k in range(1, 6)) + """ FROM y),
x AS (SELECT y, 1.0 AS x0, (row_number() OVER (ORDER BY month) - 1)::DOUBLE AS x1, """ + ", ".join(
    f"L{k} AS x{k + 1}" for k in range(1, 6)) + """ FROM l WHERE L5 IS NOT NULL)""" + _ols_sql(7) + f"""
SELECT {_OLS_TERMS!r}[t] AS term, {stable_round_sql("mm[t][8]", 6)} AS coef,
       {stable_round_sql("sqrt(rss / (n - 7) * mm[t][8 + t])", 6)} AS std_err, n::BIGINT AS nobs,
       {stable_round_sql("rss", 6)} AS rss FROM t, fin, rs""")
def q_ols_lagged(spark, d):
    """y ~ trend + L1..L5 on the rows where all five lags exist; trend restarts at 0 there."""
    lagged = B.lags(monthly_series(spark, d), [], ["month"], "y", range(1, 6), fmt="L{k}").dropna()
    x = with_positions(lagged, ["month"], name="trend")
    out = M.ols(x, "y", ["trend", "L1", "L2", "L3", "L4", "L5"])
    return out.withColumns({c: stable_round(c, 6) for c in ("coef", "std_err", "rss")})


@register("ols_trend_residuals", sql="WITH" + _MONTHLY_SQL + """,
f AS (SELECT regr_slope(y, trend) AS b, regr_intercept(y, trend) AS a FROM p)
SELECT month, trend, round((y) + 5.123e-10, 6) AS y, round((y - (a + b * trend)) + 5.123e-10, 6) AS resid FROM p, f""")
def q_ols_trend_residuals(spark, d):
    r = M.trend_residuals(_with_trend(spark, d), "y", "trend")
    return r.select("month", "trend", stable_round("y", 6).alias("y"), stable_round("resid", 6).alias("resid"))


@register("acf", sql="WITH" + _MONTHLY_SQL + """,
f AS (SELECT regr_slope(y, trend) AS b, regr_intercept(y, trend) AS a FROM p),
r AS (SELECT trend, y - (a + b * trend) AS e FROM p, f),
d AS (SELECT trend, e - avg(e) OVER () AS e FROM r),
k AS (SELECT unnest(generate_series(0, 36)) AS lag)
SELECT k.lag::BIGINT AS lag, round((sum(d1.e * d2.e) / (SELECT sum(e * e) FROM d)) + 5.123e-13, 9) AS acf
FROM k JOIN d d1 ON true JOIN d d2 ON d2.trend = d1.trend - k.lag GROUP BY k.lag""")
def q_acf(spark, d):
    r = M.trend_residuals(_with_trend(spark, d), "y", "trend")
    return M.acf(r, "resid", ["trend"], nlags=36).withColumn("acf", stable_round("acf", 9))


@register("pacf", sql="WITH RECURSIVE" + _MONTHLY_SQL + """,
f AS (SELECT regr_slope(y, trend) AS b, regr_intercept(y, trend) AS a FROM p),
r AS (SELECT trend, y - (a + b * trend) AS e FROM p, f),
d AS (SELECT trend, e - avg(e) OVER () AS e FROM r),
k AS (SELECT unnest(generate_series(0, 36)) AS lag),
ac AS (SELECT k.lag, sum(d1.e * d2.e) / (SELECT sum(e * e) FROM d) AS acf
       FROM k JOIN d d1 ON true JOIN d d2 ON d2.trend = d1.trend - k.lag GROUP BY k.lag),
rl AS (SELECT list(acf ORDER BY lag) AS rr FROM ac),
dl(m, phi, pk) AS (
  SELECT 1, [rr[2]], rr[2] FROM rl
  UNION ALL
  SELECT m + 1, list_append(list_transform(phi, lambda x, j: x - q * phi[m + 1 - j]), q), q
  FROM (SELECT m, phi, (rr[m + 2] - list_sum(list_transform(phi, lambda x, j: x * rr[m + 2 - j])))
                       / (1 - list_sum(list_transform(phi, lambda x, j: x * rr[j + 1]))) AS q
        FROM dl, rl WHERE m < 36))
SELECT 0::BIGINT AS lag, 1.0::DOUBLE AS pacf
UNION ALL SELECT m::BIGINT, """ + stable_round_sql("pk", 6) + """ FROM dl""")
def q_pacf(spark, d):
    """Durbin-Levinson over the residual ACF (the SQL oracle runs the same recursion as a
    recursive CTE over the 37 autocorrelations)."""
    r = M.trend_residuals(_with_trend(spark, d), "y", "trend")
    return M.pacf_from_acf(M.acf(r, "resid", ["trend"], nlags=36)).withColumn("pacf", stable_round("pacf", 6))


@register("ols_differenced", sql="WITH" + _MONTHLY_SQL + """,
dy AS (SELECT trend, y - lag(y) OVER (ORDER BY trend) AS dy FROM p),
l AS (SELECT dy, lag(dy) OVER (ORDER BY trend) AS ldy FROM dy)
SELECT round((regr_intercept(dy, ldy)) + 5.123e-10, 6) AS intercept, round((regr_slope(dy, ldy)) + 5.123e-10, 6) AS slope,
       regr_count(dy, ldy)::BIGINT AS nobs FROM l""")
def q_ols_differenced(spark, d):
    s = B.lags(monthly_series(spark, d), [], ["month"], "y", [1], fmt="_y1").withColumn("dy", F.col("y") - F.col("_y1"))
    s = B.lags(s, [], ["month"], "dy", [1], fmt="ldy")
    return s.agg(stable_round(F.regr_intercept("dy", "ldy"), 6).alias("intercept"),
                 stable_round(F.regr_slope("dy", "ldy"), 6).alias("slope"),
                 F.regr_count("dy", "ldy").cast("bigint").alias("nobs"))


@register("seasonal_decompose", sql="WITH" + _MONTHLY_SQL + """,
t AS (SELECT *, CASE WHEN count(y) OVER w = 13 THEN (sum(y) OVER w - 0.5 * lag(y, 6) OVER (ORDER BY trend)
                - 0.5 * lead(y, 6) OVER (ORDER BY trend)) / 12 END AS tr
      FROM p WINDOW w AS (ORDER BY trend ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)),
s AS (SELECT trend % 12 AS phase, avg(y - tr) AS pm FROM t GROUP BY 1),
c AS (SELECT phase, pm - avg(pm) OVER () AS seasonal FROM s)
SELECT month, round((tr) + 5.123e-10, 6) AS trend, round((seasonal) + 5.123e-10, 6) AS seasonal,
       round((y - tr - seasonal) + 5.123e-10, 6) AS resid FROM t JOIN c ON t.trend % 12 = c.phase""")
def q_seasonal_decompose(spark, d):
    out = M.seasonal_decompose(monthly_series(spark, d), "y", ["month"], period=12)
    return out.select("month", *[stable_round(c, 6).alias(c) for c in ("trend", "seasonal", "resid")])


# ---------------------------------------------------------------- M8, M9: forecasts
# AR(1) on w = (1 - B)(1 - B^12) y, the monthly series; see operators/forecast.py.

_R = stable_round_sql
_FORECAST_SQL = """,
l AS (SELECT month, y, lag(y, 1) OVER o AS y1, lag(y, 12) OVER o AS y12, lag(y, 13) OVER o AS y13
      FROM p WINDOW o AS (ORDER BY month)),
x AS (SELECT *, lag(w) OVER (ORDER BY month) AS wl FROM (SELECT *, y - y1 - y12 + y13 AS w FROM l)),
f AS (SELECT regr_intercept(w, wl) AS c, regr_slope(w, wl) AS phi,
             sqrt((regr_syy(w, wl) - regr_sxy(w, wl) * regr_sxy(w, wl) / regr_sxx(w, wl)) / (regr_count(w, wl) - 2)) AS sigma
      FROM x)"""

DYNAMIC_CUTOFF = "2000-01-01"


@register("forecast_one_step", sql="WITH" + _MONTHLY_SQL + _FORECAST_SQL + f""",
q AS (SELECT month, y, y1 + y12 - y13 + c + phi * wl AS pr, sigma FROM x, f WHERE wl IS NOT NULL)
SELECT month, {_R('y')} AS y, {_R('pr')} AS predicted, {_R('pr - 1.96 * sigma')} AS lower,
       {_R('pr + 1.96 * sigma')} AS upper FROM q""")
def q_forecast_one_step(spark, d):
    """Prediction at each month from the actual history, with a 95 % band."""
    out = FC.one_step(monthly_series(spark, d), "y", ["month"], p=1, season=12)
    return out.select("month", *[stable_round(c, 6).alias(c) for c in ("y", "predicted", "lower", "upper")])


@register("forecast_dynamic", sql="WITH" + _MONTHLY_SQL + _FORECAST_SQL + f""",
o AS (SELECT *, row_number() OVER (ORDER BY month) - 1 AS pos FROM x),
t AS (SELECT min(pos) - 1 AS tt FROM o WHERE month >= TIMESTAMP '{DYNAMIC_CUTOFF}'),
st AS (SELECT w AS wt, y - y12 AS ut FROM o, t WHERE pos = tt),
an AS (SELECT pos - tt + 12 AS r, y AS anchor FROM o, t WHERE pos > tt - 12 AND pos <= tt),
g AS (SELECT month, y, pos - tt AS h, c, phi, sigma, wt, ut FROM o, t, f, st WHERE pos > tt),
k AS (SELECT *, ut + CASE WHEN phi = 1 THEN wt * h + c * h * (h + 1) / 2
                     ELSE wt * (phi * (1 - pow(phi, h)) / (1 - phi)) + c * (h - phi * (1 - pow(phi, h)) / (1 - phi)) / (1 - phi) END AS u,
              CASE WHEN phi = 1 THEN h ELSE (1 - pow(phi, h)) / (1 - phi) END AS cj, ((h - 1) % 12) + 1 AS r FROM g),
m AS (SELECT *, sum(u) OVER (PARTITION BY r ORDER BY h ROWS UNBOUNDED PRECEDING) AS usum,
                sum(cj) OVER (PARTITION BY r ORDER BY h ROWS UNBOUNDED PRECEDING) AS psi FROM k),
v AS (SELECT *, anchor + usum AS pr, 1.96 * sigma * sqrt(sum(psi * psi) OVER (ORDER BY h ROWS UNBOUNDED PRECEDING)) AS half
      FROM m JOIN an USING (r))
SELECT month, {_R('y')} AS y, h::BIGINT AS h, {_R('pr')} AS predicted, {_R('pr - half')} AS lower,
       {_R('pr + half')} AS upper FROM v""")
def q_forecast_dynamic(spark, d):
    """From 2000-01 on, forecasts feed the later forecasts; the band widens with psi-weights."""
    cut = F.col("month") >= F.lit(DYNAMIC_CUTOFF).cast("timestamp")
    out = FC.dynamic(monthly_series(spark, d), "y", ["month"], cut, season=12)
    return out.select("month", stable_round("y", 6).alias("y"), "h",
                      *[stable_round(c, 6).alias(c) for c in ("predicted", "lower", "upper")])


# ---------------------------------------------------------------- M5

@register("adf_test")
def q_adf_test(spark, d):
    """ADF on the monthly series and on its first difference (one row each)."""
    y = monthly_series(spark, d)
    dy = B.lags(y, [], ["month"], "y", [1], fmt="_y1").select("month", (F.col("y") - F.col("_y1")).alias("y"))
    both = y.select(F.lit("level").alias("series"), "month", "y").unionByName(
        dy.filter(F.col("y").isNotNull()).select(F.lit("diff").alias("series"), "month", "y"))
    return M.adf_test(both, "y", ["month"], by=["series"])


# ---------------------------------------------------------------- M10

@register("forest_grid_search")
def q_forest_grid_search(spark, d):
    """Document quality from language, source, length and word count: random forest over the
    operator's default grid, 6 depths x 3 leaf sizes, 5-fold cross-validated accuracy. Of the
    reference's 7 x 3 x 3 grid depth 40 and ``min_samples_split`` have no counterpart in Spark."""
    from framewise.operators.models import forest_grid_search
    docs = table(spark, d, "documents", ["doc_id", "lang", "source", "n_chars", "text"])
    lab = table(spark, d, "labels", ["doc_id", "quality"])
    data = lab.join(docs, "doc_id").select("quality", "lang", "source", "n_chars",
                                           F.size(F.split(F.trim("text"), r"\s+")).alias("n_words"))
    return forest_grid_search(data, "quality", ["lang", "source"], ["n_chars", "n_words"])
