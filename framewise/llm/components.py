"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.session import cut_lineage


def _minima(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(``u``, ``v``): every node of the edges but the roots, with the smallest node of its component.

    Each round links the larger neighbours of a node, then its smaller ones, to the smallest it knows; the
    number of rounds grows with the logarithm of the longest path. Minima are aggregated before the shuffle
    and joined back, so a node with very many edges is split like any skewed join key. Self links are left
    out; rounds are written to the checkpoint folder and end when one changes nothing."""
    edges = cut_lineage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_minima(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = (large.join(_minima(large), "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
                 .select("e.*").where("u <> v").distinct())
        edges = cut_lineage(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges
        seen = now
