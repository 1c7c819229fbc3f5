"""The Python path: Arrow-batched pandas code inside Spark tasks.

Used only where a user function is the point of the operator. Nothing here hands a
whole group to one Python call: group-wise user logic is split into per-batch partial
results (pandas) that Spark combines with an ordinary partial aggregation, and a
per-row finishing step (pandas again) after the combined statistics are joined back.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from framewise.functions.numeric import EARTH_RADIUS_KM
from framewise.session import cut_lineage

log = logging.getLogger("framewise")


def apply_rows(df: DataFrame, fn: Callable[..., pd.Series], columns: Sequence[str], name: str, returns: str | DataType) -> DataFrame:
    """``apply(fn, axis=1)``: adds ``name``, what ``fn`` makes of the given columns. ``fn`` takes and returns
    pandas Series, one Arrow batch at a time; wrap a function of single values in ``each_row``."""
    @F.pandas_udf(returns)
    def call(*values: pd.Series) -> pd.Series:
        return fn(*values)
    return df.withColumn(name, call(*columns))


def each_row(fn: Callable) -> Callable[..., pd.Series]:
    """A function of one row's values as a function of Series (row-at-a-time Python, the slow path)."""
    return lambda *columns: pd.Series([fn(*v) for v in zip(*columns)])


def group_aggregate(df: DataFrame, by: Sequence[str], partial: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                    merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A user's aggregate in two steps, so that no group is handed whole to Python: ``partial`` turns an Arrow
    batch into rows of its groups' partial results (the ``by`` columns, then those of ``schema``), ``merge`` puts
    the table of partial results together with Spark aggregations."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = ", ".join([*(f"`{b}` {kinds[b]}" for b in by), schema])
    names = [f.name for f in _parse(out).fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield partial(b).reset_index()[names]
    return merge(df.mapInPandas(run, out))


def group_apply(df: DataFrame, by: Sequence[str], partial: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                merge: Callable[[DataFrame], DataFrame], finish: Callable[[pd.DataFrame], pd.Series], name: str,
                returns: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``groupby(by).apply(fn)`` that answers row by row: ``group_aggregate`` over ``columns`` (default: all) makes one
    row a group, which is joined to the group's rows; ``finish`` turns a batch of these into the values of ``name``."""
    stats = group_aggregate(df.select(*by, *columns) if columns else df, by, partial, schema, merge)
    extra = [c for c in stats.columns if c not in by]
    if set(extra) & set(df.columns):
        raise ValueError(f"merged columns clash with the table's: {sorted(set(extra) & set(df.columns))}")
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != name), f"`{name}` {returns}"])
    keep = [c for c in df.columns if c != name]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[keep].assign(**{name: finish(b)})
    return df.join(stats, list(by), "left").mapInPandas(run, out)


def _parse(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def great_circle_pandas(lat1: pd.Series, lng1: pd.Series, lat2: pd.Series, lng2: pd.Series) -> pd.Series:
    """Vectorised great-circle distance (km) of whole batches -- the replacement for a per-row ``apply(axis=1)``."""
    here, there = (np.stack([np.cos(lat) * np.cos(lng), np.cos(lat) * np.sin(lng), np.sin(lat)])
                   for lat, lng in ((np.radians(lat1), np.radians(lng1)), (np.radians(lat2), np.radians(lng2))))
    across = np.linalg.norm(np.cross(here, there, axis=0), axis=0)
    return pd.Series(np.arctan2(across, (here * there).sum(axis=0)) * EARTH_RADIUS_KM)


def group_zscore_pandas(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """``groupby(by)[value].apply(lambda x: (x - x.mean()) / x.std())`` with pandas doing the arithmetic:
    (n, mean, squared deviations from it) of each batch and group, combined around the group's smallest
    batch mean (sums of squares would cancel for large means)."""
    by = list(by)

    def partial(b: pd.DataFrame) -> pd.DataFrame:
        g = b.assign(_x=b[value].astype("float64")).groupby(by, dropna=False)["_x"]
        return pd.DataFrame({"_n": g.count(), "_m": g.mean(), "_d": g.var(ddof=0) * g.count()})

    def merge(parts: DataFrame) -> DataFrame:
        parts = cut_lineage(parts.where("_n > 0"), "zscore-parts")
        off = parts.join(parts.groupBy(*by).agg(F.min("_m").alias("_base")), by).withColumn("_off", F.col("_m") - F.col("_base"))
        sums = off.groupBy(*by).agg(F.first("_base").alias("_base"), F.sum("_n").alias("_n"), F.sum(F.col("_n") * F.col("_off")).alias("_o"),
                                    F.sum(F.col("_d") + F.col("_n") * F.col("_off") * F.col("_off")).alias("_q"))
        return sums.select(*by, "_n", (F.col("_base") + F.col("_o") / F.col("_n")).alias("_m"),
                           (F.col("_q") - F.col("_o") * F.col("_o") / F.col("_n")).alias("_d"))

    def finish(b: pd.DataFrame) -> pd.Series:
        var = b["_d"] / (b["_n"].astype("float64") - 1)
        z = (b[value].astype("float64") - b["_m"]) / np.sqrt(var.where(var > 0))
        return z.replace([np.inf, -np.inf], np.nan)

    return group_apply(df, by, partial, "_n long, _m double, _d double", merge, finish, name, "double", [value])


def group_mode_pandas(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """A custom aggregate (most frequent value, ties -> smallest) written with pandas:
    each Arrow batch yields its value counts per group; Spark sums the counts and picks
    the winner with a partial-aggregable ``min_by``."""
    by = list(by)
    kind = df.schema[value].dataType.simpleString()

    def partial(b: pd.DataFrame) -> pd.DataFrame:
        return b[b[value].notna()].groupby(by + [value], dropna=False).size().rename("_n").reset_index().set_index(by)

    def merge(parts: DataFrame) -> DataFrame:
        c = parts.groupBy(*by, value).agg(F.sum("_n").alias("_n"))
        return c.groupBy(*by).agg(F.min_by(F.col(value), F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))).alias(name))

    return group_aggregate(df.select(*by, value), by, partial, f"`{value}` {kind}, _n long", merge)


def logged(name: str, fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Decorator for a ``df -> df`` step: logs the output schema at once; the row count is observed while the
    user's own action runs (no extra job), and ``report()``, called after it, logs and returns the counts."""
    def wrapper(df: DataFrame, *a, **k) -> DataFrame:
        out = fn(df, *a, **k)
        obs = Observation()
        wrapper.observations.append(obs)
        log.info("%s: columns %s", name, [f"{f.name}:{f.dataType.simpleString()}" for f in out.schema.fields])
        return out.observe(obs, F.count(F.lit(1)).alias("rows"))

    def report() -> list[int]:
        counts = [obs.get["rows"] for obs in wrapper.observations]
        wrapper.observations.clear()
        for n in counts:
            log.info("%s: %d rows", name, n)
        return counts
    wrapper.observations = []
    wrapper.report = report
    wrapper.__name__ = getattr(fn, "__name__", name)
    return wrapper
