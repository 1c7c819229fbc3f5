"""Nearest places on a sphere, without pairing every point with every other.

Places become unit vectors, and the cube around the sphere is cut into cells of side 2^-level, so that neither
poles nor the date line are special. A query meets the places of its cell and the 26 around it by one equi-join. What
lies outside that ring is farther than a cell's side as the crow flies through the sphere; so a query whose k-th
best is nearer is done, and the others go on with cells of twice the side, until a ring holds the whole sphere.
Crowded regions set the first level: no cell holds more than ``CELL_PLACES`` places there, if places differ enough. Points at
one place are one place, with the ids that can be in an answer. The queries of a round are dealt to so many tasks that each
meets some ``MET_ROWS`` places, counted by cells beforehand: a small file of queries can meet many.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.functions.numeric import EARTH_RADIUS_KM, great_circle
from framewise.session import cut_lineage

CELL_PLACES = 256
MET_ROWS = 500_000   # pairs of query and place that a task compares
FINEST = 24   # cells of some 0.4 m on the earth
WHOLE = -1    # cells of side 2: a ring is everything


def _located(df: DataFrame, id_col: str, lat: str, lon: str) -> DataFrame:
    """(``id``, ``lat``, ``lon``, unit vector) of the rows that have a place."""
    a, b = F.radians("lat"), F.radians("lon")
    return (df.select(F.col(id_col).alias("id"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
            .where("id IS NOT NULL AND abs(lat) <= 90 AND abs(lon) < double('inf')")
            .select("id", "lat", "lon", (F.cos(a) * F.cos(b)).alias("x"), (F.cos(a) * F.sin(b)).alias("y"), F.sin(a).alias("z")))


def _cell(level: int) -> list[Column]:
    return [F.floor((F.col(c) + 1) * 2.0 ** level).cast("int").alias(f"c{c}") for c in "xyz"]


def _ring(df: DataFrame) -> DataFrame:
    """Each row once for its cell and the 26 around it."""
    for c in "xyz":
        df = df.withColumn("step", F.explode(F.array(*[F.lit(i) for i in (-1, 0, 1)]))).withColumn(f"c{c}", F.col(f"c{c}") + F.col("step")).drop("step")
    return df


def _met_rows(asking: DataFrame, places: DataFrame, level: int) -> int:
    """Pairs of query and place that a round at ``level`` compares, from counts by cell."""
    ask = _ring(asking.groupBy(*_cell(level)).agg(F.count("*").alias("asking"))).groupBy("cx", "cy", "cz").agg(F.sum("asking").alias("asking"))
    there = places.groupBy(*_cell(level)).agg(F.count("*").alias("there"))
    return int(ask.join(there, ["cx", "cy", "cz"]).agg(F.sum(F.col("asking") * F.col("there").cast("double"))).first()[0] or 0)


def nearest_places(queries: DataFrame, points: DataFrame, k: int = 1, query: tuple[str, str, str] = ("id", "lat", "lon"),
                   point: tuple[str, str, str] = ("id", "lat", "lon"), radius: float = EARTH_RADIUS_KM, digits: int = 6,
                   cell_places: int = CELL_PLACES) -> DataFrame:
    """(``query_id``, ``rank``, ``point_id``, ``distance``): the ``k`` points nearest to each query, exact.

    ``query`` and ``point`` name the id, latitude and longitude (degrees) columns. Distances are great-circle ones, rounded to ``digits``; equal ones
    rank by smaller point id. Rows without an id or a place (NULL, not finite, a latitude beyond 90) take no part; repeated ids of points
    are one point a place, repeated queries are one. Fewer than ``k`` points give fewer ranks."""
    if k < 1:
        raise ValueError("k must be 1 or more")
    first_ids = Window.partitionBy("lat", "lon").orderBy("id")
    places = (_located(points, *point).dropDuplicates(["id", "lat", "lon"]).withColumn("n", F.row_number().over(first_ids)).where(F.col("n") <= k)
              .groupBy("lat", "lon", "x", "y", "z").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    places = cut_lineage(places, "places")
    n = places.count()
    level = max(WHOLE, min(FINEST, int(math.log2(max(1.0, n / (8 * k))) / 2)))
    while level < FINEST and (places.groupBy(*_cell(level)).count().agg(F.max("count")).first()[0] or 0) > cell_places:
        level += 1
    pending = cut_lineage(_located(queries, *query).dropDuplicates(["id", "lat", "lon"]).withColumnsRenamed(
        {c: f"q_{c}" for c in ("id", "lat", "lon")}), "asking")
    who = ["q_id", "q_lat", "q_lon"]
    done = None
    while True:
        tasks = max(1, math.ceil(_met_rows(pending, places, level) / MET_ROWS))
        asked = _ring(pending.repartition(tasks, *who).select(*who, *_cell(level)))
        distance = F.round(great_circle("q_lat", "q_lon", "lat", "lon", radius), digits)
        met = (asked.select(*who, "cx", "cy", "cz").join(places.select("lat", "lon", "ids", *_cell(level)), ["cx", "cy", "cz"])
               .select(*who, "ids", distance.alias("distance")))
        near = met.withColumn("n", F.row_number().over(Window.partitionBy(*who).orderBy("distance", F.element_at("ids", 1)))).where(F.col("n") <= k)
        best = (near.select(*who, "distance", F.explode("ids").alias("point_id"))
                .withColumn("rank", F.row_number().over(Window.partitionBy(*who).orderBy("distance", "point_id"))).where(F.col("rank") <= k))
        best = cut_lineage(best, "nearest")
        if level > WHOLE:
            # the arc over a chord of one side, less than the digits that rounding may hide
            arc = 2 * math.asin(min(1.0, 2.0 ** -level / 2)) * radius * (1 - 1e-9) - 10.0 ** -digits
            enough = best.groupBy(*who).agg(F.count("*").alias("n"), F.max("distance").alias("far")).where((F.col("n") == k) & (F.col("far") <= arc))
            enough = cut_lineage(enough.select(*who), "found")
            part = best.join(enough, who, "left_semi")
            pending = cut_lineage(pending.join(enough, who, "left_anti"), "asking")
        else:
            part = best
        part = part.select(F.col("q_id").alias("query_id"), "rank", "point_id", "distance")
        done = part if done is None else done.unionByName(part)
        if level == WHOLE or pending.isEmpty():
            return done
        level -= 1
