"""Time-bucket resampling on a timestamp column.

A bucket is a pure expression of the row (``date_trunc``), so grouping on it is a normal
partial+final aggregation. Empty buckets come from a spine, which the plan makes from the
bounds; nothing goes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.session import cut_lineage

#: Timestamps of a spine that one task makes at a time.
SPINE_ROWS = 65_536
_UNIT_MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def bucket(ts: str | Column, unit: str) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc(unit, c)


def week_ending_sunday(ts: str | Column) -> Column:
    """``resample("W")`` label: weeks run Monday..Sunday and carry the Sunday's date."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_add(F.date_trunc("week", c).cast("date"), 6)


def month_start(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.trunc(c, "MM")


def spine(ends: DataFrame, unit: str, name: str, every: int = 1) -> DataFrame:
    """Every timestamp ``lo``, ``lo`` + ``every`` units, ... <= ``hi`` of a table of one row (or a few) with these columns.

    It never leaves the plan, so no driver's time zone matters: steps of days and longer follow the calendar of the
    session's zone (of no zone for TIMESTAMP_NTZ), shorter ones are exact. The steps are dealt to tasks in chunks. NULL
    bounds give no row."""
    unit = unit.upper()
    steps = ends.select(F.col("lo").alias("_fw_lo"), F.expr(f"timestampdiff({unit}, lo, hi) div {every}").alias("_fw_n"))
    chunks = (steps.where("_fw_n >= 0").select("*", F.explode(F.expr(f"sequence(0L, _fw_n div {SPINE_ROWS})")).alias("_fw_chunk"))
              .repartition("_fw_chunk"))
    last = F.least(F.col("_fw_n"), F.col("_fw_chunk") * SPINE_ROWS + (SPINE_ROWS - 1))
    return (chunks.select("_fw_lo", F.explode(F.sequence(F.col("_fw_chunk") * SPINE_ROWS, last)).alias("_fw_i"))
            .select(F.expr(f"timestampadd({unit}, cast(_fw_i * {every} as int), _fw_lo)").alias(name)))


def bucket_spine(df: DataFrame, ts: str, unit: str, name: str, step: str | None = None, every: int = 1) -> DataFrame:
    """Every bucket of ``unit`` (second to year, week and month too) between a column's first and last; with ``step``
    every ``every`` steps between those two buckets. The bounds are aggregated in the plan."""
    b = bucket(ts, unit)
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        b = b.cast("timestamp_ntz")
    return spine(df.agg(F.min(b).alias("lo"), F.max(b).alias("hi")), step or unit, name, every)


def resample_agg(df: DataFrame, ts: str, unit: str, aggs: Sequence[Column], name: str = "bucket",
                 by: Sequence[str] = (), fill_empty: bool = True) -> DataFrame:
    """``resample(unit).agg(...)``; with ``fill_empty`` every bucket between the first and
    last appears (aggregates of an empty bucket are NULL; wrap sums in coalesce for 0), with
    ``by`` between each key's own first and last. The bounds come from the aggregated table."""
    g = df.groupBy(*by, bucket(ts, unit).alias(name)).agg(*aggs)
    if not fill_empty:
        return g
    return fill_buckets(g, name, f"INTERVAL '{_UNIT_MICROS[unit] // 1_000_000}' SECOND", by)


def fill_buckets(g: DataFrame, name: str, step: str, by: Sequence[str] = (), fills: dict | None = None) -> DataFrame:
    """Add the missing buckets of an aggregated table, ``step`` (an SQL interval, of months too)
    apart, between the first and the last (of each key, with ``by``). Their columns are NULL, or
    what ``fills`` says. The bounds come from the aggregated table, which is written once."""
    g = cut_lineage(g, "resampled")
    ends = g.groupBy(*by).agg(F.min(name).alias("_fw_lo"), F.max(name).alias("_fw_hi")).where(F.col("_fw_lo").isNotNull())
    spine_rows = ends.select(*[F.col(b).alias(f"_fw_{b}") for b in by], F.explode(F.sequence("_fw_lo", "_fw_hi", F.expr(step))).alias(f"_fw_{name}"))
    on = F.col(f"_fw_{name}") == F.col(name)
    for b in by:
        on = on & F.col(f"_fw_{b}").eqNullSafe(F.col(b))
    rest = [c for c in g.columns if c != name and c not in by]
    out = spine_rows.join(g, on, "left").select(*[F.col(f"_fw_{b}").alias(b) for b in by], F.col(f"_fw_{name}").alias(name), *rest)
    return out.fillna(fills) if fills else out


def resample_by_keys(df: DataFrame, ts: str, unit: str, key: str, keys: Sequence | DataFrame, value: Column,
                     name: str = "bucket", value_name: str = "n", fill=0) -> DataFrame:
    """``groupby([key, Grouper(freq)])`` on a *category* key: every bucket x every category
    in ``keys``, empty cells filled with ``fill``. A given list is exploded on the distributed
    bucket spine; a table of categories (one column, each once, of any number) is crossed
    with it, as every pair is in the result."""
    counts = cut_lineage(df.groupBy(key, bucket(ts, unit).alias(name)).agg(value.alias(value_name)), "resampled")
    spine = bucket_spine(counts, name, unit, name)
    if isinstance(keys, DataFrame):
        grid = spine.crossJoin(keys.toDF(key))
    else:
        grid = spine.select(name, F.explode(F.array(*[F.lit(k) for k in keys])).alias(key))
    out = grid.join(counts, [key, name], "left")
    return out.withColumn(value_name, F.coalesce(F.col(value_name), F.lit(fill)))


def resample_n_days(date: str | Column, n: int, first: Column) -> Column:
    """``resample("5d")`` anchored at midnight of the first row: first + n*floor(days/n)."""
    d = (F.col(date) if isinstance(date, str) else date).cast("date")
    f = first.cast("date")
    return F.date_add(f, (F.floor(F.datediff(d, f) / n) * n).cast("int"))
