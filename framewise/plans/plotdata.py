"""V-rows: chart tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.functions.numeric import stable_round
from framewise.operators import blocked as B
from framewise.operators import plotdata as V
from framewise.operators.aggregates import group_mean_all, value_counts
from framewise.operators.filters import sample_rows
from framewise.operators.joins import reindex_range
from framewise.operators.reshape import melt
from framewise.plans.registry import register
from framewise.sources.tables import table


def _rnd(df, cols, n=6):
    return df.withColumns({c: stable_round(F.col(c), n) for c in cols})


@register("count_by_category", sql="""
WITH c AS (SELECT p_size, count(*) AS count FROM part GROUP BY 1),
s AS (SELECT unnest(generate_series(min(p_size), max(p_size))) AS p_size FROM c)
SELECT s.p_size::INTEGER AS p_size, coalesce(c.count, 0) AS count FROM s LEFT JOIN c USING (p_size)""")
def q_count_by_category(spark, d):
    c = value_counts(table(spark, d, "part", ["p_size"]), "p_size")
    return reindex_range(c, "p_size", "count", 0)


@register("box_stats", sql="""
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT e.event_type, round((q1) + 5.123e-10, 6) AS q1, round((median) + 5.123e-10, 6) AS median, round((q3) + 5.123e-10, 6) AS q3,
  min(value) FILTER (WHERE value >= lo AND value <= hi) AS whisker_lo, max(value) FILTER (WHERE value >= lo AND value <= hi) AS whisker_hi,
  count(*) FILTER (WHERE value < lo OR value > hi) AS n_outliers, count(value) AS n
FROM events e JOIN f USING (event_type) GROUP BY e.event_type, q1, median, q3""")
def q_box_stats(spark, d):
    ev = table(spark, d, "events", ["event_type", "value"])
    return _rnd(V.box_stats(ev, ["event_type"], "value"), ["q1", "median", "q3"])


@register("mean_ci", sql="""
SELECT o_orderpriority, o_orderstatus, round((avg(o_totalprice)) + 5.123e-08, 4) AS mean,
  round((avg(o_totalprice) - 1.96 * stddev_samp(o_totalprice) / sqrt(count(o_totalprice))) + 5.123e-08, 4) AS ci_lo,
  round((avg(o_totalprice) + 1.96 * stddev_samp(o_totalprice) / sqrt(count(o_totalprice))) + 5.123e-08, 4) AS ci_hi,
  count(o_totalprice) AS n FROM orders GROUP BY 1, 2""")
def q_mean_ci(spark, d):
    o = table(spark, d, "orders", ["o_orderpriority", "o_orderstatus", "o_totalprice"])
    return _rnd(V.mean_ci(o, ["o_orderpriority", "o_orderstatus"], "o_totalprice"), ["mean", "ci_lo", "ci_hi"], 4)


@register("regression_by_group", sql="""
SELECT l_returnflag, round((regr_slope(l_extendedprice, l_quantity)) + 5.123e-10, 6) AS slope,
  round((regr_intercept(l_extendedprice, l_quantity)) + 5.123e-10, 6) AS intercept,
  regr_count(l_extendedprice, l_quantity)::BIGINT AS n, round((regr_r2(l_extendedprice, l_quantity)) + 5.123e-13, 9) AS r2
FROM lineitem GROUP BY 1""")
def q_regression_by_group(spark, d):
    li = table(spark, d, "lineitem", ["l_returnflag", "l_extendedprice", "l_quantity"])
    out = V.regression_by_group(li, ["l_returnflag"], "l_extendedprice", "l_quantity")
    return _rnd(_rnd(out, ["slope", "intercept"]), ["r2"], 9).withColumn("n", F.col("n").cast("bigint"))


@register("histogram", sql="""
WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT least(floor((l_extendedprice - lo) / ((hi - lo) / 20)), 19)::INTEGER AS bin, lo, hi FROM lineitem, r)
SELECT bin, count(*) AS n, round((any_value(lo) + bin * (any_value(hi) - any_value(lo)) / 20) + 5.123e-08, 4) AS edge_lo
FROM b GROUP BY bin""")
def q_histogram(spark, d):
    h = V.histogram(table(spark, d, "lineitem", ["l_extendedprice"]), "l_extendedprice", 20)
    return _rnd(h, ["edge_lo"], 4)


@register("bin_2d", sql="""
WITH r AS (SELECT min(p_size) AS xlo, max(p_size) AS xhi, min(p_retailprice) AS ylo, max(p_retailprice) AS yhi FROM part)
SELECT least(floor((p_size - xlo) / ((xhi - xlo) / 20)), 19)::INTEGER AS bin_x,
       least(floor((p_retailprice - ylo) / ((yhi - ylo) / 20)), 19)::INTEGER AS bin_y, count(*) AS n
FROM part, r GROUP BY 1, 2""")
def q_bin_2d(spark, d):
    return V.bin_2d(table(spark, d, "part", ["p_size", "p_retailprice"]), "p_size", "p_retailprice", 20)


@register("kde", sql="""
WITH s AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n, stddev_samp(value) AS sd FROM events),
p AS (SELECT value AS x, count(*) AS c FROM events GROUP BY 1),
g AS (SELECT unnest(generate_series(0, 63)) AS point),
k AS (SELECT point, lo + point * (hi - lo) / 63 AS gx, sd * pow(n::DOUBLE, -0.2) AS h, n FROM g, s)
SELECT point::INTEGER AS point, round((sum(c * exp(-0.5 * ((gx - x) / h) * ((gx - x) / h))) / (any_value(n) * any_value(h) * sqrt(2 * pi()))) + 5.123e-13, 9) AS density,
       round((any_value(gx)) + 5.123e-10, 6) AS x
FROM k, p GROUP BY point""")
def q_kde(spark, d):
    out = V.kde(table(spark, d, "events", ["value"]), "value", 64)
    return _rnd(_rnd(out, ["density"], 9), ["x"], 6)


@register("scatter_sample", sql="""
SELECT p_partkey, p_size, p_retailprice FROM part ORDER BY md5(concat_ws('|', p_partkey::VARCHAR, '7')) LIMIT 200""")
def q_scatter_sample(spark, d):
    return sample_rows(table(spark, d, "part", ["p_partkey", "p_size", "p_retailprice"]), 200, ["p_partkey"], seed=7)


@register("band_mean_std", sql="""
WITH s AS (SELECT o_orderdate AS day, sum(o_totalprice) / 1000 AS revenue_k FROM orders GROUP BY 1),
w AS (SELECT day, CASE WHEN count(revenue_k) OVER w >= 30 THEN avg(revenue_k) OVER w END AS m,
             CASE WHEN count(revenue_k) OVER w >= 30 THEN stddev_samp(revenue_k) OVER w END AS sd
      FROM s WINDOW w AS (ORDER BY day ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING))
SELECT day, round((m) + 5.123e-08, 4) AS mean, round((m - sd) + 5.123e-08, 4) AS lower, round((m + sd) + 5.123e-08, 4) AS upper FROM w""")
def q_band_mean_std(spark, d):
    s = table(spark, d, "orders", ["o_orderdate", "o_totalprice"]).groupBy(F.col("o_orderdate").alias("day")).agg(
        (F.sum("o_totalprice") / 1000).alias("revenue_k"))
    r = B.rolling(s, [], ["day"], "revenue_k", 30, ["mean", "std"], center=True, fmt="{agg}")
    out = r.select("day", F.col("mean"), (F.col("mean") - F.col("std")).alias("lower"), (F.col("mean") + F.col("std")).alias("upper"))
    return _rnd(out, ["mean", "lower", "upper"], 4)


@register("strip_long", sql="""
WITH m AS (SELECT p_brand, avg(p_size) AS p_size, avg(p_retailprice) AS p_retailprice FROM part GROUP BY 1)
SELECT p_brand, 'p_size' AS variable, round((p_size) + 5.123e-10, 6) AS value FROM m
UNION ALL SELECT p_brand, 'p_retailprice', round((p_retailprice) + 5.123e-10, 6) FROM m""")
def q_strip_long(spark, d):
    m = group_mean_all(table(spark, d, "part", ["p_brand", "p_size", "p_retailprice"]), ["p_brand"])
    return _rnd(melt(m, ["p_brand"], ["p_size", "p_retailprice"]), ["value"])
