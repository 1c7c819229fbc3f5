"""Row filters and predicates. Filters stay plain Column predicates so Catalyst pushes
them into the parquet scan (PushedFilters)."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_mask(df: DataFrame, cond) -> DataFrame:
    """Boolean mask or callable mask (``loc[lambda df: ...]``)."""
    return df.filter(cond(df) if callable(cond) else cond)


def between(column: str | Column, lo=None, hi=None, inclusive: str = "neither") -> Column:
    """Chained comparison ``lo < x < hi`` (``inclusive`` in neither/both/left/right)."""
    c = F.col(column) if isinstance(column, str) else column
    cond = F.lit(True)
    if lo is not None:
        cond = cond & ((c >= lo) if inclusive in ("both", "left") else (c > lo))
    if hi is not None:
        cond = cond & ((c <= hi) if inclusive in ("both", "right") else (c < hi))
    return cond


def filter_isin(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Membership in a literal list (absent labels simply match nothing)."""
    return df.filter(F.col(column).isin(list(values)))


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent non-NULL values (ties broken by value): at most k rows."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column).count()
            .orderBy(F.col("count").desc(), F.col(column).asc()).limit(k).select(column))


def filter_isin_topk(df: DataFrame, column: str, k: int) -> DataFrame:
    """Keep rows whose ``column`` is among the k most frequent values. The count is a
    partial+final aggregation; the k-row answer is broadcast into a left-semi join."""
    return df.join(F.broadcast(top_values(df, column, k)), column, "left_semi")


def slice_keys(df: DataFrame, selection: Mapping[str, Sequence | None]) -> DataFrame:
    """``loc[(L0 list, L1 list)]`` / ``IndexSlice[:, L1]``: AND of ``isin`` per key; None = all."""
    cond = F.lit(True)
    for c, vals in selection.items():
        if vals is not None:
            vals = list(vals) if isinstance(vals, (list, tuple, set)) else [vals]
            cond = cond & F.col(c).isin(vals)
    return df.filter(cond)


def _period(text: str) -> tuple[dt.datetime, dt.datetime]:
    """Partial date string -> half-open [start, end) of the named period."""
    m = re.fullmatch(r"(\d{4})(?:-(\d{1,2})(?:-(\d{1,2})(?:[ T](\d{1,2})(?::(\d{2}))?)?)?)?", text.strip())
    if not m:
        raise ValueError(f"cannot parse date label {text!r}")
    y, mo, d, h, mi = m.groups()
    y = int(y)
    if mo is None:
        return dt.datetime(y, 1, 1), dt.datetime(y + 1, 1, 1)
    mo = int(mo)
    if d is None:
        nxt = dt.datetime(y + (mo == 12), mo % 12 + 1, 1)
        return dt.datetime(y, mo, 1), nxt
    start = dt.datetime(y, mo, int(d))
    if h is None:
        return start, start + dt.timedelta(days=1)
    start = start.replace(hour=int(h))
    if mi is None:
        return start, start + dt.timedelta(hours=1)
    start = start.replace(minute=int(mi))
    return start, start + dt.timedelta(minutes=1)


def date_label_range(start: str, end: str | None = None) -> tuple[dt.datetime, dt.datetime]:
    """``loc["2011":"2016"]``: both ends inclusive to the end of the named period."""
    lo, hi = _period(start)
    if end is not None:
        hi = _period(end)[1]
    return lo, hi


def slice_date_string(df: DataFrame, column: str, start: str, end: str | None = None) -> DataFrame:
    """Label slicing on a timestamp column as a half-open range on the raw column, so the
    predicate reaches parquet min/max statistics (never ``year(ts) = ...``)."""
    lo, hi = date_label_range(start, end)
    return df.filter((F.col(column) >= F.lit(lo)) & (F.col(column) < F.lit(hi)))


def drop_nulls(df: DataFrame, how: str = "any", thresh: int | None = None,
               subset: Sequence[str] | None = None) -> DataFrame:
    """``dropna(how / thresh / subset)``."""
    return df.dropna(how=how, thresh=thresh, subset=list(subset) if subset else None)


def filter_scalar_aggregate(df: DataFrame, column: str, op: str, scalar: Column) -> DataFrame:
    """``query("x < x.quantile(.99)")``: compare against a one-value aggregate given as a
    scalar subquery (``DataFrame.scalar()``), evaluated once, no join."""
    c = F.col(column)
    ops = {"<": c < scalar, "<=": c <= scalar, ">": c > scalar, ">=": c >= scalar,
           "==": c == scalar, "!=": c != scalar}
    return df.filter(ops[op])


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Reproducible ``sample(n, random_state)``: the n rows with the smallest
    ``md5(key || seed)``. Same answer on any engine and any partitioning; plans as a top-k."""
    h = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))
    return df.withColumn("_fw_h", h).orderBy("_fw_h").limit(n).drop("_fw_h")


def sample_fraction(df: DataFrame, frac: float, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Reproducible ``sample(frac=...)``: keep rows whose hash prefix falls under the cut.
    A pure per-row filter (no shuffle)."""
    h = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))
    cut = int(frac * 16 ** 8)
    return df.filter(F.conv(F.substring(h, 1, 8), 16, 10).cast("long") < F.lit(cut))
