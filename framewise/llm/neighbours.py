"""Approximate nearest neighbours by low-dimensional stable projections and kd-trees.

Vectors are projected to ``DIMS`` dimensions by independent standard normal (2-stable)
directions. For a vector at distance s from the query, its squared projected distance
divided by s**2 has the chi-square distribution with ``DIMS`` degrees of freedom. A search
takes candidates in rising projected distance and verifies each one's true distance; it
stops as soon as (projected distance / k-th best distance)**2 passes the chi-square
quantile ``SURE``: any vector nearer than the k-th best would have come up by then with
that probability. There is no cap on candidates.

On Spark: equal vectors are indexed once, with the smallest ids they stand for, and asked
once; but a query whose id stands on several rows is asked by itself, and what has only its
own id is left out before anything is cut to the nearest. A kd-tree
over the projections, split at medians of a bounded sample, cuts the space into cells;
cells hold shards of about ``SHARD_ROWS`` vectors, each a kd-tree of its own. Queries search
the cell they fall in first; the distance they find there bounds the radius at which the
test must stop, and they are sent on to just those cells that the radius reaches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.llm.text import require
from framewise.session import cut_lineage

DIMS = 12
SURE = 0.95
SAMPLE_ROWS = 20_000  # vectors whose projections place the cuts between cells, at most
CELL_SAMPLE = 40      # of them at least in each cell
SHARD_ROWS = 8192
LEAF_ROWS = 64
SEED = 7


def chi_square_quantile(p: float, k: int) -> float:
    """By bisection on the regularised lower incomplete gamma function (its power series)."""
    def below(x: float) -> float:
        a, z = k / 2, x / 2
        term = total = 1 / a
        n = a
        while term > total * 1e-15:
            n += 1
            term *= z / n
            total += term
        return total * math.exp(a * math.log(z) - z - math.lgamma(a))
    lo, hi = 1e-9, 10.0 * k + 100
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return lo


def directions(length: int, dims: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((length, dims))


def kd_cells(points: np.ndarray, leaf_rows: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Rows of each leaf of a kd-tree split at medians along the widest side, and the leaves' cuts (lows, highs):
    unbounded where no cut was made."""
    leaves, lows, highs = [], [], []
    work = [(np.arange(len(points)), np.full(points.shape[1], -np.inf), np.full(points.shape[1], np.inf))]
    while work:
        rows, low, high = work.pop()
        if len(rows) > leaf_rows:
            spread = np.ptp(points[rows], axis=0)
            d = int(spread.argmax())
            if spread[d] > 0:
                x = points[rows, d]
                cut = np.partition(x, len(x) // 2)[len(x) // 2]
                left = x < cut
                if not left.any():  # more than half are the smallest value
                    cut = x[x > cut].min()
                    left = x < cut
                up, down = low.copy(), high.copy()
                up[d] = down[d] = cut
                work += [(rows[~left], up, high), (rows[left], low, down)]
                continue
        leaves.append(rows)
        lows.append(low)
        highs.append(high)
    return leaves, np.array(lows), np.array(highs)


def box_distance(lows: np.ndarray, highs: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt((np.maximum(0.0, np.maximum(lows - point, point - highs)) ** 2).sum(axis=1))


class Shard:
    """kd-tree over one shard's projections, with the vectors for verification."""

    def __init__(self, vectors: np.ndarray, projected: np.ndarray):
        leaves, _, _ = kd_cells(projected, LEAF_ROWS)
        order = np.concatenate(leaves)
        self.order, self.vectors, self.projected = order, vectors[order], projected[order]
        self.ends = np.cumsum([len(x) for x in leaves])
        self.starts = self.ends - [len(x) for x in leaves]
        self.lows = np.minimum.reduceat(self.projected, self.starts, axis=0)
        self.highs = np.maximum.reduceat(self.projected, self.starts, axis=0)

    def search(self, q: np.ndarray, p: np.ndarray, k: int, stop: float, bound: float, barred: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, distances) of the k nearest found, without the ``barred`` rows; ``bound``: a k-th best distance known from elsewhere."""
        reach = box_distance(self.lows, self.highs, p)
        leaves = np.argsort(reach, kind="stable")
        rows, dist = np.zeros(0, np.int64), np.zeros(0)
        waiting, near = np.zeros(0, np.int64), np.zeros(0)
        for i, leaf in enumerate(leaves):
            span = np.arange(self.starts[leaf], self.ends[leaf])
            if len(barred):
                span = span[~np.isin(self.order[span], barred)]
            waiting = np.concatenate([waiting, span])
            near = np.concatenate([near, np.sqrt(((self.projected[span] - p) ** 2).sum(axis=1))])
            # what is no farther than every leaf still closed comes next, in order of projected distance
            border = reach[leaves[i + 1]] if i + 1 < len(leaves) else np.inf
            ready = near <= border
            if not ready.any():
                continue
            worst = min(bound, dist[-1] if len(dist) == k else np.inf)
            turn = waiting[ready][near[ready] <= stop * worst]
            last = near[ready].max()
            waiting, near = waiting[~ready], near[~ready]
            if len(turn):
                rows = np.concatenate([rows, turn])
                dist = np.concatenate([dist, np.sqrt(((self.vectors[turn] - q) ** 2).sum(axis=1))])
                best = np.lexsort((rows, dist))[:k]
                rows, dist = rows[best], dist[best]
            worst = min(bound, dist[-1] if len(dist) == k else np.inf)
            if max(last, border) > stop * worst:  # the chi-square test: nothing nearer is to be expected
                if not len(near) or near.min() > stop * worst:
                    break
        return self.order[rows], dist


def _numbers(column: pa.Array) -> np.ndarray:
    """Rows x length, double precision; all lists have one length and no NULL."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(``id``, ``v``) without vectors that are NULL, empty, zero, or hold NULL or non-finite components."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.select(F.col(id_col).alias("id"), v.alias("v")).where("id is not null").where(fine)


def nearest(queries: DataFrame, rows: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            dims: int = DIMS, sure: float = SURE, seed: int = SEED) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): the ``k`` nearest found of each query among the rows with
    another id, nearest first, ties to the smaller id; ``score`` is the Euclidean distance in double precision.

    Rows with a NULL id, and vectors that are NULL, empty, zero or hold NULL or non-finite components, take no
    part; vectors must have one length. An id on several rows counts as several candidates, all of them barred
    from a query of that id. Queries need not be among the rows. Fewer candidates give fewer ranks; an empty
    table gives an empty result. Columns besides id and vector are ignored."""
    require(rows, id_col, vector_col)
    require(queries, id_col, vector_col)
    spark = rows.sparkSession
    candidates = usable(rows, id_col, vector_col)
    # one place more than k is enough for a query's own row; where its id has several, they are left out by ``own``
    several = candidates.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id", F.col("id").alias("own"))
    asked = usable(queries, id_col, vector_col).join(several, "id", "left")
    schema = "query_id long, rank int, vec_id long, score double"
    # equal vectors once: of their ids only the k + 1 smallest, and of each id k rows, can be in an answer
    by_id = Window.partitionBy("v").orderBy("id")
    reps = (candidates.groupBy("v", "id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("times"))
            .withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= k + 1)
            .groupBy("v").agg(F.sort_array(F.collect_list(F.struct("id", "times"))).alias("ids"))
            .withColumn("ids", F.flatten(F.transform("ids", lambda x: F.array_repeat(x["id"], x["times"])))))
    reps = cut_lineage(reps, "ann-vectors")
    shape = reps.agg(F.count("*").alias("n"), F.min(F.size("v")).alias("lo"), F.max(F.size("v")).alias("hi")).first()
    if not shape["n"]:
        return spark.createDataFrame([], schema)
    if shape["lo"] != shape["hi"]:
        raise ValueError("vectors must have one length")
    basis = spark.sparkContext.broadcast(directions(shape["hi"], dims, seed))
    stop = math.sqrt(chi_square_quantile(sure, dims))

    sample = reps.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE_ROWS).toArrow().column("v").combine_chunks()
    points = _numbers(sample) @ basis.value
    wanted = max(1, min(len(points) // CELL_SAMPLE, shape["n"] // SHARD_ROWS))
    _, lows, highs = kd_cells(points, -(-len(points) // wanted))
    cells = spark.sparkContext.broadcast((lows, highs))  # at most SAMPLE_ROWS / CELL_SAMPLE * 2 boxes
    salts = max(1, math.ceil(shape["n"] / len(lows) / SHARD_ROWS))

    def cell_of(p: np.ndarray) -> np.ndarray:
        lo, hi = cells.value
        out = np.zeros(len(p), np.int32)
        for i in range(len(lo)):
            out[((p >= lo[i]) & (p < hi[i])).all(axis=1)] = i
        return out

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell_of(_numbers(b.column("v")) @ basis.value))], names=[*b.schema.names, "cell"])

    shard = F.concat_ws("-", "cell", F.pmod(F.xxhash64("v"), F.lit(salts)))
    none = F.lit(None)
    index = (reps.mapInArrow(place, "v array<double>, ids array<long>, cell int")
             .select(shard.alias("shard"), "v", none.cast("long").alias("own"), "ids", none.cast("double").alias("bound")))
    wants = cut_lineage(asked.select("v", "own").distinct().mapInArrow(place, "v array<double>, own long, cell int"), "ann-queries")
    parts = max(1, shape["n"] // SHARD_ROWS)
    found_schema = "v array<double>, own long, ids array<long>, d double"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard, each shard's vectors before its queries."""
        now, tree, held, ids, alone = None, None, [], [], {}
        for b in batches:
            names, vectors = b.column("shard").to_pylist(), _numbers(b.column("v"))
            indexed = b.column("ids").is_valid().to_numpy(zero_copy_only=False)
            bounds, id_lists = b.column("bound").to_numpy(zero_copy_only=False), b.column("ids").to_pylist()
            owns = b.column("own").to_pylist()
            out = [], [], [], []
            for i, name in enumerate(names):
                if name != now:
                    now, tree, held, ids, alone = name, None, [], [], {}
                if indexed[i]:
                    if id_lists[i][0] == id_lists[i][-1]:  # sorted: a single id
                        alone.setdefault(id_lists[i][0], []).append(len(held))
                    held.append(vectors[i])
                    ids.append(id_lists[i])
                    continue
                if not held:
                    continue
                if tree is None:
                    stacked = np.array(held)
                    tree = Shard(stacked, stacked @ basis.value)
                bound = bounds[i] if bounds[i] == bounds[i] else np.inf
                barred = np.array(alone.get(owns[i], []), np.int64)
                for row, d in zip(*tree.search(vectors[i], vectors[i] @ basis.value, k + 1, stop, bound, barred), strict=True):
                    out[0].append(vectors[i])
                    out[1].append(owns[i])
                    out[2].append(ids[row] if owns[i] is None else [x for x in ids[row] if x != owns[i]])
                    out[3].append(float(d))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.list_(pa.float64())), pa.array(out[1], pa.int64()),
                                                  pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.float64())],
                                                 names=["v", "own", "ids", "d"])

    def run(routed: DataFrame) -> DataFrame:
        return (index.unionByName(routed.select("shard", "v", "own", none.cast("array<long>").alias("ids"), "bound"))
                .repartition(parts, "shard").sortWithinPartitions("shard", F.col("ids").isNull())
                .mapInArrow(search, found_schema))

    def all_shards(routed: DataFrame) -> DataFrame:
        salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
        return routed.withColumn("salt", salt).withColumn("shard", F.concat_ws("-", "cell", "salt"))

    first = cut_lineage(run(all_shards(wants.withColumn("bound", none.cast("double")))), "ann-own-cell")
    near = Window.partitionBy("v", "own").orderBy("d")
    kth = (first.withColumn("n", F.row_number().over(near)).where(F.col("n") <= k + 1)
           .groupBy("v", "own").agg(F.when(F.count("*") > k, F.max("d")).alias("bound")))

    def same(df: DataFrame, other: DataFrame) -> Column:
        return (df["v"] == other["v"]) & df["own"].eqNullSafe(other["own"])

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The other cells that a query's stopping radius meets."""
        lo, hi = cells.value
        for b in batches:
            vectors, home, owns = _numbers(b.column("v")), b.column("cell").to_numpy(), b.column("own").to_pylist()
            bounds = b.column("bound").to_numpy(zero_copy_only=False)
            out = [], [], [], []
            for i in range(len(vectors)):
                bound = bounds[i] if bounds[i] == bounds[i] else np.inf
                met = np.flatnonzero(box_distance(lo, hi, vectors[i] @ basis.value) <= stop * bound)
                met = met[met != home[i]]
                out[0].extend([vectors[i]] * len(met))
                out[1].extend([owns[i]] * len(met))
                out[2].extend([bounds[i] if bound < np.inf else None] * len(met))
                out[3].extend(met.tolist())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.list_(pa.float64())), pa.array(out[1], pa.int64()),
                                              pa.array(out[2], pa.float64()), pa.array(out[3], pa.int32())],
                                             names=["v", "own", "bound", "cell"])

    further = (wants.join(kth, same(wants, kth), "left").select(wants["v"], wants["own"], "cell", "bound")
               .mapInArrow(reach, "v array<double>, own long, bound double, cell int"))
    found = first.unionByName(run(all_shards(further)))
    best = (found.withColumn("n", F.row_number().over(Window.partitionBy("v", "own").orderBy("d", F.element_at("ids", 1))))
            .where(F.col("n") <= k + 1).select("v", "own", "d", F.explode("ids").alias("vec_id")))
    short = (best.withColumn("n", F.row_number().over(Window.partitionBy("v", "own").orderBy("d", "vec_id"))).where(F.col("n") <= k + 1)
             .groupBy("v", "own").agg(F.sort_array(F.collect_list(F.struct("d", "vec_id"))).alias("near")))
    short = cut_lineage(short, "ann-near")
    mine = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("id")), 1, k)
    return (asked.join(short, same(asked, short)).select(F.col("id").alias("query_id"), F.posexplode(mine))
            .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("col.vec_id"), F.col("col.d").alias("score")))
