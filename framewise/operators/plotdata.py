"""The tables behind common charts (box plots, interval bars, histograms, 2-D bins,
kernel densities). Drawing is out of scope; each function returns the numbers a chart
would show, computed with distributive aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.operators.aggregates import quantiles


def box_stats(df: DataFrame, by: Sequence[str], value: str, whis: float = 1.5) -> DataFrame:
    """Box plot per group: q1, median, q3, whiskers at the most extreme values within
    q1 - whis*IQR .. q3 + whis*IQR, and the count of points outside (outliers)."""
    by = list(by)
    q = quantiles(df, [value], [0.25, 0.5, 0.75], by,
                  names={(value, 0.25): "q1", (value, 0.5): "median", (value, 0.75): "q3"})
    q = q.withColumn("_fw_lo", F.col("q1") - whis * (F.col("q3") - F.col("q1"))).withColumn(
        "_fw_hi", F.col("q3") + whis * (F.col("q3") - F.col("q1")))
    # one row per group: AQE broadcasts it when small, else a shuffle join on the keys
    j = df.select(*by, value).join(q, by, "inner") if by else df.select(value).join(F.broadcast(q), how="inner")
    v = F.col(value)
    inside = (v >= F.col("_fw_lo")) & (v <= F.col("_fw_hi"))
    return j.groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_lo"), F.max(F.when(inside, v)).alias("whisker_hi"),
        F.count_if(~inside).cast("bigint").alias("n_outliers"), F.count(v).alias("n"))


def mean_ci(df: DataFrame, by: Sequence[str], value: str, z: float = 1.96) -> DataFrame:
    """Bar/point plot numbers: mean and a normal-approximation 95 % interval per group."""
    m, s, n = F.avg(value), F.stddev_samp(value), F.count(value)
    half = F.lit(z) * s / F.sqrt(n)
    return df.groupBy(*by).agg(m.alias("mean"), (m - half).alias("ci_lo"), (m + half).alias("ci_hi"), n.alias("n"))


def regression_by_group(df: DataFrame, by: Sequence[str], y: str, x: str) -> DataFrame:
    """Regression-plot numbers per facet: slope, intercept, n, r²."""
    return df.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                               F.regr_count(y, x).alias("n"), F.regr_r2(y, x).alias("r2"))


def bin_index(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin 0..bins-1 over [lo, hi]; the maximum falls into the last bin."""
    width = (hi - lo) / bins
    return F.least(F.floor((x - lo) / width), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, value: str, bins: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """Counts in ``bins`` equal-width bins between the column's min and max."""
    r = df.select(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("r")).scalar()
    b = bin_index(F.col(value), r["lo"], r["hi"], bins)
    g = df.filter(F.col(value).isNotNull()).groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (r["hi"] - r["lo"]) / bins
    return g.withColumn("edge_lo", r["lo"] + F.col("bin") * width)


def bin_2d(df: DataFrame, x: str, y: str, gridsize: int = 20) -> DataFrame:
    """Hexbin-style density as rectangular bins: counts on a gridsize x gridsize grid."""
    r = df.select(F.struct(F.min(x).alias("xlo"), F.max(x).alias("xhi"), F.min(y).alias("ylo"),
                           F.max(y).alias("yhi")).alias("r")).scalar()
    bx = bin_index(F.col(x), r["xlo"], r["xhi"], gridsize)
    by_ = bin_index(F.col(y), r["ylo"], r["yhi"], gridsize)
    return df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(
        bx.alias("bin_x"), by_.alias("bin_y")).agg(F.count(F.lit(1)).alias("n"))


def kde(df: DataFrame, value: str, grid: int = 64) -> DataFrame:
    """Gaussian kernel density on ``grid`` points spanning [min, max], Scott bandwidth (sample std * n^(-1/5)).

    Exact, in one aggregation with a sum for each grid point: every task sends ``grid`` numbers, whatever its rows, and neither
    rows nor distinct values are shuffled. NULLs are left out; no values give no rows, and values without spread NULL densities."""
    stats = df.select(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(value).alias("n"),
                               F.stddev_samp(value).alias("sd")).alias("s")).scalar()
    h = F.nullif(stats["sd"] * F.pow(stats["n"].cast("double"), F.lit(-0.2)), F.lit(0.0))
    step = (stats["hi"] - stats["lo"]) / (grid - 1)
    placed = df.filter(F.col(value).isNotNull()).select(((F.col(value) - stats["lo"]) / h).alias("_fw_x"), (step / h).alias("_fw_step"))

    def weight(point: int) -> Column:
        z = F.col("_fw_step") * point - F.col("_fw_x")
        return F.exp(-0.5 * z * z)
    sums = placed.agg(F.count(F.lit(1)).alias("_fw_n"), *[F.sum(weight(i)).alias(f"_fw_{i}") for i in range(grid)]).where("_fw_n > 0")
    listed = sums.select("_fw_n", F.posexplode(F.array(*[F.col(f"_fw_{i}") for i in range(grid)])).alias("point", "_fw_sum"))
    return listed.select("point", (F.col("_fw_sum") / (F.col("_fw_n") * h * F.lit(math.sqrt(2 * math.pi)))).alias("density"),
                         (stats["lo"] + F.col("point") * step).alias("x"))
