"""Group z-score, trend, and a rolling window for tables of buckets. Ordered windows over rows are in ``blocked``.

Group statistics that do not need an order are a partial aggregation joined back instead
of a window, so a hot group is combined map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewise.operators.ordering import with_positions


_AGGS = {"sum": F.sum, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "count": F.count}


def rolling(df: DataFrame, value: str, n: int, order: Sequence, by: Sequence[str] = (), agg: str = "sum",
            name: str | None = None, center: bool = False, min_periods: int | None = None) -> DataFrame:
    """``rolling(n).agg()`` over rows: NULL until ``min_periods`` (default n) non-NULL values
    sit in the frame. ``center=True`` puts rows i-n//2 .. i+n-n//2-1 in the frame."""
    lo, hi = (-(n // 2), n - n // 2 - 1) if center else (-(n - 1), 0)
    w = Window.partitionBy(*by).orderBy(*[F.col(o) if isinstance(o, str) else o for o in order]).rowsBetween(lo, hi)
    need = n if min_periods is None else min_periods
    guard = F.count(F.col(value)).over(w) >= need
    return df.withColumn(name or f"{value}_{agg}{n}", F.when(guard, _AGGS[agg](F.col(value)).over(w)))


def group_zscore(df: DataFrame, by: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """``(x - mean) / std`` per group (sample std). Group stats come from a partial
    aggregation joined back on the keys (AQE turns the join into a broadcast when the
    stats table is small and splits a skewed key on the big side)."""
    stats = df.groupBy(*by).agg(F.avg(value).alias("_fw_mu"), F.stddev_samp(value).alias("_fw_sd"))
    out = df.join(stats, list(by), "left")
    return (out.withColumn(name or f"{value}_z", F.try_divide(F.col(value) - F.col("_fw_mu"), F.col("_fw_sd")))
            .drop("_fw_mu", "_fw_sd"))


def trend(df: DataFrame, order: Sequence, name: str = "trend") -> DataFrame:
    """``trend = arange(len)`` over the whole table, range-partitioned (no single task)."""
    return with_positions(df, order, (), name=name)
