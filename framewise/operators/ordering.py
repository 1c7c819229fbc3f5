"""Row positions, sorting and top-k.

Rows of a DataFrame have no order. Everything order-dependent here takes an explicit
``order`` list that must be unique inside each group (append a tie-break key). NULL sorts
last.

``with_positions`` is the skew-safe replacement for ``row_number()`` over a huge (or
unpartitioned) window. Rows are range-partitioned by (group keys, order) -- Spark samples a
bounded number of keys of each input partition -- and written once, each with the number
of its partition, its chunk. The input is read once; a lost executor later reads the
written rows again and cannot land in another chunk. Rows are numbered inside (chunk, group)
windows, whose size is bounded by the chunk even when one group holds a third of the
table, and a small table of chunk counts supplies the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.session import cut_lineage

def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def with_positions(df: DataFrame, order: Sequence, by: Sequence[str] = (), name: str = "pos",
                   size_name: str | None = None, partitions: int | None = None, weight: str | None = None) -> DataFrame:
    """Add ``name`` = 0-based position of the row inside its ``by`` group under ``order``
    (ascending, NULL last; pass ``-x`` for a descending numeric key). Optionally add
    ``size_name`` = rows in the group. NULL group keys form their own group. With ``weight``
    each row stands for that many rows: the position is that of the first of them."""
    by = list(by)
    work = df
    okeys = []
    for i, o in enumerate(order):
        if isinstance(o, str):
            okeys.append(o)
        else:
            work = work.withColumn(f"_fw_o{i}", o)
            okeys.append(f"_fw_o{i}")
    ordered = [F.col(k).asc_nulls_last() for k in okeys]
    work = cut_lineage(work.repartitionByRange(_partitions(df, partitions), *by, *ordered)
                       .withColumn("_fw_chunk", F.spark_partition_id()), "positions")
    own = F.col(weight) if weight else F.lit(1)
    before = Window.partitionBy("_fw_chunk", *by).orderBy(*ordered).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(own).over(before), F.lit(0)) if weight else F.row_number().over(
        Window.partitionBy("_fw_chunk", *by).orderBy(*ordered)) - 1
    # One row per (chunk, group): at most (#groups + #chunks) rows.
    stats = work.groupBy("_fw_chunk", *by).agg(F.sum(own).alias("_fw_n"))
    w_prev = Window.partitionBy(*by).orderBy("_fw_chunk").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_fw_off", F.coalesce(F.sum("_fw_n").over(w_prev), F.lit(0)))
    if size_name:
        stats = stats.withColumn(size_name, F.sum("_fw_n").over(Window.partitionBy(*by)))
    keep = [F.col("_fw_chunk").alias("_fw_cchunk"), "_fw_off"] + ([size_name] if size_name else [])
    stats = stats.select(*keep, *[F.col(b).alias(f"_fw_k{i}") for i, b in enumerate(by)])
    if not by:
        stats = F.broadcast(stats)  # one row per chunk
    cond = F.col("_fw_chunk") == F.col("_fw_cchunk")
    for i, b in enumerate(by):
        cond = cond & F.col(b).eqNullSafe(F.col(f"_fw_k{i}"))
    out = work.withColumn("_fw_local", local).join(stats, cond, "inner").withColumn(name, F.col("_fw_off") + F.col("_fw_local"))
    return out.select(*df.columns, name, *([size_name] if size_name else []))


def row_number_global(df: DataFrame, order: Sequence, name: str = "row_number") -> DataFrame:
    """1-based position over the whole table (``arange``/``game_id`` from row position)."""
    return with_positions(df, order, (), name="_fw_pos").withColumn(
        name, F.col("_fw_pos") + 1).drop("_fw_pos")


def positional_rows(df: DataFrame, order: Sequence, start: int | None = None, stop: int | None = None,
                    by: Sequence[str] = ()) -> DataFrame:
    """``iloc[start:stop]`` in ``order`` (negative bounds count from the end, per group)."""
    p = with_positions(df, order, by, name="_fw_pos", size_name="_fw_size")
    cond = F.lit(True)
    if start is not None:
        lo = F.lit(start) if start >= 0 else F.col("_fw_size") + start
        cond = cond & (F.col("_fw_pos") >= lo)
    if stop is not None:
        hi = F.lit(stop) if stop >= 0 else F.col("_fw_size") + stop
        cond = cond & (F.col("_fw_pos") < hi)
    return p.filter(cond).drop("_fw_pos", "_fw_size")


def columns_by_position(df: DataFrame, start: int | None = None, stop: int | None = None) -> DataFrame:
    """``df.columns[2:]``-style projection."""
    return df.select(*df.columns[start:stop])


def sort_rows(df: DataFrame, order: Sequence, name: str = "position") -> DataFrame:
    """``sort_values`` / ``sort_index``, NULL last. The sort is kept as a 1-based ``position``
    column: the rows are range-sorted for it once, and the order survives later steps."""
    return row_number_global(df, order, name)


def top_k(df: DataFrame, value: str, k: int, tie_break: Sequence[str] = (), largest: bool = True) -> DataFrame:
    """``nlargest(k)`` / ``nsmallest(k)``: NULL excluded, ties broken by ``tie_break``.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps only its own
    k best rows, so the final merge sees k x tasks rows whatever the table size.
    """
    v = F.col(value).desc() if largest else F.col(value).asc()
    return df.filter(F.col(value).isNotNull()).orderBy(v, *[F.col(t).asc() for t in tie_break]).limit(k)


def top_k_per_group(df: DataFrame, by: Sequence[str], value: str, k: int,
                    tie_break: Sequence[str] = (), largest: bool = True) -> DataFrame:
    """k best rows per group; row_number() <= k plans as WindowGroupLimit (partial top-k
    before the shuffle)."""
    v = F.col(value).desc() if largest else F.col(value).asc()
    w = Window.partitionBy(*by).orderBy(v, *[F.col(t).asc() for t in tie_break])
    return (df.filter(F.col(value).isNotNull()).withColumn("_fw_rn", F.row_number().over(w))
            .filter(F.col("_fw_rn") <= k).drop("_fw_rn"))


def sort_tail(df: DataFrame, value: str, k: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """``sort_values(value).tail(k)``: ascending sort puts NULLs last, so NULL rows are part of
    the tail. Planned as a reversed top-k (no full sort)."""
    return df.orderBy(F.col(value).desc_nulls_first(), *[F.col(t).desc() for t in tie_break]).limit(k)


def head(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """First n rows in an explicit order."""
    return df.orderBy(*[_col(o) for o in order]).limit(n)
