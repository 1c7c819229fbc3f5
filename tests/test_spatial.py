"""Nearest places against all distances."""

import math
import re

import numpy as np
import pytest

from framewise.operators import spatial


def distance(a, b):
    (p, q), (r, s) = (tuple(map(math.radians, x)) for x in (a, b))
    t = s - q
    east, north = math.cos(r) * math.sin(t), math.cos(p) * math.sin(r) - math.sin(p) * math.cos(r) * math.cos(t)
    return math.atan2(math.hypot(east, north), math.sin(p) * math.sin(r) + math.cos(p) * math.cos(r) * math.cos(t)) * 6373.0


def brute(queries, points, k):
    out = []
    for q, *at in queries:
        seen = sorted({(round(distance(at, p), 6), i) for i, *p in points})
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(seen[:k])]
    return sorted(out)


def run(spark, queries, points, k, **kw):
    kind = "id long, lat double, lon double"
    got = spatial.nearest_places(spark.createDataFrame(queries, kind), spark.createDataFrame(points, kind), k, **kw).collect()
    return sorted((r["query_id"], r["rank"], r["point_id"], r["distance"]) for r in got)


def same(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=2e-6)


def test_clustered_places_poles_and_date_line(spark):
    rng = np.random.default_rng(9)
    points = [(i, float(a), float(b)) for i, (a, b) in enumerate(np.column_stack([rng.uniform(-90, 90, 150), rng.uniform(-180, 180, 150)]))]
    points += [(1000 + i, 48.1 + float(x), 11.5 + float(y)) for i, (x, y) in enumerate(rng.normal(0, 0.01, (300, 2)))]  # a crowd
    points += [(2000 + i, 90.0, 0.0) for i in range(4)] + [(3000, -17.0, 179.99), (3001, -17.0, -179.98)]
    queries = [(i, float(a), float(b)) for i, (a, b) in enumerate(np.column_stack([rng.uniform(-90, 90, 25), rng.uniform(-180, 180, 25)]))]
    queries += [(100, 89.9, 77.0), (101, -89.9, -5.0), (102, -17.0, -180.0), (103, -17.0, 180.0), (104, 48.1, 11.5), (105, 48.5, 11.0)]
    same(run(spark, queries, points, 3, cell_places=20), brute(queries, points, 3))


def test_ties_repeats_nulls_and_few_points(spark):
    points = [(5, 1.0, 0.0), (4, -1.0, 0.0), (3, 0.0, 1.0), (3, 0.0, 1.0), (7, 1.0, 0.0), (None, 0.0, 0.0), (8, None, 0.0), (9, 95.0, 0.0), (10, 0.0, float("nan"))]
    fit = [p for p in points if p[0] in (3, 4, 5, 7)]
    queries = [(1, 0.0, 0.0), (1, 0.0, 0.0), (2, 0.0, 180.0)]
    same(run(spark, [*queries, (3, None, 1.0)], points, 3), brute(queries[1:], fit, 3))
    same(run(spark, queries, points, 50), brute(queries[1:], fit, 50))
    assert run(spark, queries, [], 2) == [] and run(spark, [], points, 2) == []


def test_queries_of_one_file_are_dealt_to_tasks(spark, monkeypatch):
    tasks, cut = [], spatial.cut_lineage

    def kept(df, name="cut"):
        if name == "nearest":
            plan = df._jdf.queryExecution().executedPlan().toString()
            tasks.append(max(map(int, re.findall(r"hashpartitioning\(q_id.*?, (\d+)\), REPARTITION_BY_NUM", plan)), default=1))
        return cut(df, name)

    monkeypatch.setattr(spatial, "cut_lineage", kept)
    monkeypatch.setattr(spatial, "MET_ROWS", 1000, raising=False)
    rng = np.random.default_rng(4)
    points, queries = ([(i, float(a), float(b)) for i, (a, b) in enumerate(np.column_stack([rng.uniform(-90, 90, n), rng.uniform(-180, 180, n)]))] for n in (100, 400))
    same(run(spark, queries, points, 3), brute(queries, points, 3))
    assert tasks[0] >= 5  # a query meets 20 to 30 places there: some 10 rounds of MET_ROWS
