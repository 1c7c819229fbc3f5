"""Set operations on key columns (Index set algebra) and row concatenation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """``concat([...], ignore_index=True)``: columns matched by name, missing ones NULL.
    For many files prefer one glob scan over a thousand-branch union."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def intersect(*frames: DataFrame) -> DataFrame:
    """``A & B & C`` (distinct)."""
    return reduce(lambda a, b: a.intersect(b), frames)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """``A | B``."""
    return a.unionByName(b).distinct()


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """``A.difference(B)``: distinct rows of A absent from B (null-safe, like EXCEPT)."""
    return a.subtract(b)


def symmetric_difference(a: DataFrame, b: DataFrame, key: str, side: str = "side") -> DataFrame:
    """``A ^ B`` with a column telling which side each value came from. One full join of
    the two distinct key sets."""
    l = a.select(F.col(key).alias("_fw_l")).distinct()
    r = b.select(F.col(key).alias("_fw_r")).distinct()
    j = l.join(r, F.col("_fw_l").eqNullSafe(F.col("_fw_r")), "full")
    j = j.filter(F.col("_fw_l").isNull() | F.col("_fw_r").isNull())
    return j.select(F.coalesce("_fw_l", "_fw_r").alias(key),
                    F.when(F.col("_fw_r").isNull(), F.lit("left")).otherwise(F.lit("right")).alias(side))


def distinct_values(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()
