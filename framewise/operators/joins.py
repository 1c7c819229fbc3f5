"""Joins and label alignment.

Joins carry no broadcast hints: Catalyst and AQE pick sort-merge or shuffle-hash and, at run
time, demote to broadcast on measured sizes and split skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.session import cut_lineage

#: A key is hot only above so many rows: below, splitting it gains nothing.
HOT_ROWS = 100_000


def join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
         null_safe: bool = False) -> DataFrame:
    """``merge(l, r, on, how)``. With ``null_safe`` NULL keys match each other (the
    reference's behaviour); key columns are coalesced into one column per key."""
    on = list(on)
    if not null_safe:
        return left.join(right, on, how)
    r = right.select(*[F.col(k).alias(f"_fw_r_{k}") for k in on], *[c for c in right.columns if c not in on])
    cond = None
    for k in on:
        c = F.col(k).eqNullSafe(F.col(f"_fw_r_{k}"))
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    keys = [F.coalesce(F.col(k), F.col(f"_fw_r_{k}")).alias(k) if how in ("full", "outer", "right")
            else F.col(k) for k in on]
    rest = [c for c in left.columns if c not in on] + [c for c in right.columns if c not in on]
    return out.select(*keys, *rest)


def join_small(fact: DataFrame, dim: DataFrame, on: Sequence[str] | Column, how: str = "inner") -> DataFrame:
    """Fact x dimension. AQE broadcasts the dimension when its measured bytes are few."""
    return fact.join(dim, on, how)


def hot_keys(left: DataFrame, right: DataFrame, on: Sequence[str], partitions: int, least: int = HOT_ROWS) -> DataFrame:
    """Keys that hold more rows of a side than an even share of it, and more than ``least``:
    (keys, ``_fw_a``, ``_fw_b``, ``_fw_met``): into how many parts each side's rows are dealt, and whether both sides
    hold the key (NULL keys never meet). A side has fewer than ``partitions`` such keys, so the table is small."""
    on = list(on)
    sides = [df.select(*on, F.lit(x).alias("_fw_l"), F.lit(1 - x).alias("_fw_r")) for df, x in ((left, 1), (right, 0))]
    counts = cut_lineage(sides[0].unionByName(sides[1]).groupBy(*on).agg(
        F.sum("_fw_l").alias("_fw_l"), F.sum("_fw_r").alias("_fw_r")), "join-keys")
    all_l, all_r = counts.agg(F.sum("_fw_l"), F.sum("_fw_r")).first()
    share_l, share_r = (max(least, -(-(n or 0) // partitions)) for n in (all_l, all_r))
    known = F.lit(True)
    for k in on:
        known = known & F.col(k).isNotNull()
    return (counts.where((F.col("_fw_l") > share_l) | (F.col("_fw_r") > share_r))
            .select(*on, F.greatest(F.lit(1), F.ceil(F.col("_fw_l") / share_l)).cast("int").alias("_fw_a"),
                    F.greatest(F.lit(1), F.ceil(F.col("_fw_r") / share_r)).cast("int").alias("_fw_b"),
                    (known & (F.col("_fw_l") > 0) & (F.col("_fw_r") > 0)).alias("_fw_met")))


def _dealt(df: DataFrame, hot: DataFrame, on: Sequence[str], own: str, other: str, side: str) -> DataFrame:
    """Each row with its cell (``_fw_i``, ``_fw_j``): ``own`` by a hash of the row and of its input partition, which a
    task that runs again finds unchanged; rows of a key that both sides hold are copied along ``other``."""
    cond = None
    for k in on:
        c = F.col(f"l.{k}").eqNullSafe(F.col(f"h.{k}"))
        cond = c if cond is None else cond & c
    size, copies = ("_fw_a", "_fw_b") if side == "left" else ("_fw_b", "_fw_a")
    row = df.withColumn("_fw_h", F.xxhash64(*df.columns, F.spark_partition_id()))
    place = F.pmod("_fw_h", F.coalesce(F.col(f"h.{size}"), F.lit(1))).cast("int")
    met = F.coalesce(F.col("h._fw_met"), F.lit(False))
    last = F.when(met, F.col(f"h.{copies}") - 1).otherwise(F.lit(0))
    return (row.alias("l").join(F.broadcast(hot).alias("h"), cond, "left")
            .select(*[F.col(f"l.{c}") for c in df.columns], met.alias(f"_fw_met_{side}"), F.lit(True).alias(f"_fw_{side}"),
                    place.alias(own), F.explode(F.sequence(F.lit(0), last)).alias(other)))


def join_repartitioned(left: DataFrame, right: DataFrame, on: Sequence[str], partitions: int,
                       how: str = "inner", least: int = HOT_ROWS) -> DataFrame:
    """Hash-partition both sides on the key once; the join then reuses that partitioning
    (no further exchange) -- the layout to keep when several joins/aggregations share a key.

    A partitioning asked for by number is not re-planned at run time, so hot keys are found first, by exact counts of
    the keys alone. If there are any, their left rows are dealt to ``a`` rows of a grid and copied to its ``b`` columns,
    their right rows the other way round: each pair of rows meets in one cell, and no cell holds more than about an
    even share of either side. Rows that the key has on one side alone are dealt without copies, so outer joins keep
    each once; NULL keys match nothing. ``how``: inner, left, right or full."""
    on = list(on)
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"how={how!r}: inner, left, right or full")
    hot = hot_keys(left, right, on, partitions, least)
    if hot.isEmpty():
        return left.repartition(partitions, *on).join(right.repartition(partitions, *on), on, how)
    cell = [*on, "_fw_i", "_fw_j"]
    a = _dealt(left, hot, on, "_fw_i", "_fw_j", "left").repartition(partitions, *cell)
    b = _dealt(right, hot, on, "_fw_j", "_fw_i", "right").repartition(partitions, *cell)
    both = F.col("_fw_left").isNotNull() & F.col("_fw_right").isNotNull()
    spare = F.coalesce("_fw_met_left", "_fw_met_right")  # a copy in a cell where the other side has no row
    return (a.join(b, cell, how).where(both | ~spare)
            .drop("_fw_i", "_fw_j", "_fw_left", "_fw_right", "_fw_met_left", "_fw_met_right"))


def assert_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Raise if any key appears twice (one aggregation, one row back at most)."""
    dup = df.groupBy(*key).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"key {list(key)} is not unique: {dup[0]}")
    return df


def lookup_map(df: DataFrame, column: str, mapping: DataFrame, key: str, value: str, name: str,
               check_unique: bool = True) -> DataFrame:
    """``df[column].map(series)``: left join to a key->value table, missing -> NULL. A repeated
    key raises when the rows are computed: the check is part of the plan, not a job before it."""
    m = mapping.select(F.col(key).alias("_fw_key"), F.col(value).alias(name))
    if check_unique:
        twice = F.raise_error(F.concat(F.lit(f"key {key} is not unique: "), F.col("_fw_key").cast("string"))).cast(m.schema[name].dataType)
        m = (m.groupBy("_fw_key").agg(F.count(F.lit(1)).alias("_fw_n"), F.first(name).alias(name))
             .select("_fw_key", F.when(F.col("_fw_n") > 1, twice).otherwise(F.col(name)).alias(name)))
    out = df.join(m, F.col(column) == F.col("_fw_key"), "left")
    return out.drop("_fw_key")


def align(a: DataFrame, b: DataFrame, key: Sequence[str], how: str = "full") -> DataFrame:
    """Label alignment of two keyed tables (outer union of labels by default)."""
    return a.join(b, list(key), how)


def binary_op(x: Column, y: Column, op: str) -> Column:
    if op == "div":
        return F.try_divide(x, y)
    if op == "mul":
        return x * y
    if op == "add":
        return x + y
    if op == "sub":
        return x - y
    raise ValueError(op)


def align_op(a: DataFrame, b: DataFrame, key: Sequence[str], a_val: str, b_val: str, op: str,
             name: str, fill_value=None, how: str = "full") -> DataFrame:
    """``a.div(b)`` / ``a.add(b, fill_value=0)``: full join on labels; with ``fill_value`` a
    one-sided missing value is replaced, both missing stays NULL; ÷0 gives NULL."""
    j = align(a.select(*key, F.col(a_val).alias("_fw_a")), b.select(*key, F.col(b_val).alias("_fw_b")), key, how)
    x, y = F.col("_fw_a"), F.col("_fw_b")
    if fill_value is not None:
        both_null = x.isNull() & y.isNull()
        x = F.when(~both_null, F.coalesce(x, F.lit(fill_value)))
        y = F.when(~both_null, F.coalesce(y, F.lit(fill_value)))
    return j.select(*key, binary_op(x, y, op).alias(name))


def align_frame_by_series(frame: DataFrame, series: DataFrame, key: Sequence[str], value: str,
                          op: str = "div") -> DataFrame:
    """``frame.div(series, axis="index")``: every value column of ``frame`` combined with the
    aligned series; labels are the union of both sides."""
    cols = [c for c in frame.columns if c not in key]
    j = frame.join(series.select(*key, F.col(value).alias("_fw_s")), list(key), "full")
    return j.select(*key, *[binary_op(F.col(c), F.col("_fw_s"), op).alias(c) for c in cols])


def reindex_range(df: DataFrame, key: str, value: str, fill, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """``reindex(range(min, max + 1), fill_value=fill)`` on an integer key. Bounds come from
    one aggregate row; the spine is a distributed ``spark.range``."""
    if lo is None or hi is None:
        r = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
        lo = r["lo"] if lo is None else lo
        hi = r["hi"] if hi is None else hi
    if lo is None:
        return df.limit(0)
    spine = df.sparkSession.range(int(lo), int(hi) + 1).select(F.col("id").cast(df.schema[key].dataType).alias(key))
    out = spine.join(df.select(key, value), key, "left")
    return out.withColumn(value, F.coalesce(F.col(value), F.lit(fill).cast(df.schema[value].dataType)))
