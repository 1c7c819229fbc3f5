"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Components become integers, ``floor(scale * x)``; a score is the integer inner product, so all
bounds below are exact. Rows are sorted by (length, label, Hilbert index of the vector) and cut into
blocks of ``BLOCK_ROWS``, written once as Parquet: each block is a row with its ids, labels, vectors and
its zone map, the least and greatest component in each dimension and the least and greatest label. A
range partition of the sort is a shelf of blocks, with a zone map of its own.

Interval arithmetic on an anchor and a zone map bounds every score in the block or shelf. Anchors
are routed to the shelves whose bounds let them hold an answer; there, the blocks' bounds choose
which blocks each anchor reads. First an anchor reads the shelf of the greatest bound alone; the k-th best
score found bounds what other shelves must offer. That is done twice: for the positives (same
label, any score), and for the windows of scores that each positive allows its negatives.

A shelf is held in a task once for each ``ANCHOR_GROUP`` anchors routed to it; anchors are streamed past.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.llm.text import require
from framewise.session import cut_lineage

SCALE = 256
BLOCK_ROWS = 512
#: Components in a shelf, about: 32,768 vectors of 64.
SHELF_NUMBERS = 1 << 21
ANCHOR_GROUP = 8192
#: Shelves whose zone maps are held at once; anchors that are compared at once.
ZONES, STEP = 4096, 256
#: Rows whose quantiles place the cells of the Hilbert curve, at most. Every row is indexed.
SAMPLE_ROWS = 20_000
#: Bits of a Hilbert index, over all dimensions.
KEY_BITS = 128
#: Greatest component: scores of vectors of up to 2**15 such components are exact 64-bit integers.
LARGEST = 1 << 23


# Hilbert order

def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of points with ``bits``-bit coordinates, as rows of bytes that sort like it.

    From the highest bit down, each coordinate whose bit is set reflects the first one's lower bits, each
    other one swaps them with the first's; the Gray code of what results, interleaved, is the position."""
    x = cells.astype(np.uint32).T.copy()
    dims = len(x)
    for q in (1 << k for k in range(bits - 1, 0, -1)):
        low = np.uint32(q - 1)
        for i in range(dims):
            here = (x[i] & np.uint32(q)) != 0
            swap = np.where(here, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(here, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for q in (1 << k for k in range(bits - 1, 0, -1)):
        turn ^= np.where((x[-1] & np.uint32(q)) != 0, np.uint32(q - 1), np.uint32(0))
    x ^= turn
    out = [((x[i] >> np.uint32(b)) & np.uint32(1)).astype(np.uint8) for b in range(bits - 1, -1, -1) for i in range(dims)]
    return np.packbits(np.stack(out, axis=1), axis=1)


def fit_curve(sample: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(dimensions by falling variance, cuts at their quantiles): equally many sampled rows in each cell's side."""
    dims = np.argsort(-sample.var(axis=0), kind="stable")[:KEY_BITS]
    bits = max(1, min(8, KEY_BITS // max(1, len(dims))))
    return dims, np.quantile(sample[:, dims], np.arange(1, 1 << bits) / (1 << bits), axis=0, method="lower")


def curve_keys(vectors: np.ndarray, dims: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    if not len(dims):
        return np.zeros((len(vectors), 1), np.uint8)
    cells = np.stack([np.searchsorted(cuts[:, i], vectors[:, d], "right") for i, d in enumerate(dims)], axis=1)
    return hilbert_key(cells, (len(cuts) + 1).bit_length() - 1)


# bounds and best rows

def bounds(vectors: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) inner product of each vector with anything inside each zone."""
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    return product(up, lows) + product(down, highs), product(up, highs) + product(down, lows)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; in floating point where that is exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    reach = int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1]
    if reach < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if reach < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


NONE = np.iinfo(np.int64).min + 1  # so that its negative fits too


def best_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, score, id) of the ``k`` greatest scores of each row but ``NONE``, ties to the smaller id, rows in order."""
    if scores.shape[1] > k:
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
    else:
        least = np.full(len(scores), NONE)
    row, col = np.nonzero((scores >= least[:, None]) & (scores != NONE))
    return first_of(row, scores[row, col], ids[col], k)


def first_of(row: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -score, row))
    row, score, ids = row[order], score[order], ids[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
    return row[rank < k], score[rank < k], ids[rank < k]


class Best:
    """The ``k`` best (score, id) found so far in each of a number of slots."""

    def __init__(self, slots: int, k: int):
        self.k, self.slots = k, slots
        self.row, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.row, self.score, self.ids = first_of(
            np.concatenate([self.row, row]), np.concatenate([self.score, score]), np.concatenate([self.ids, ids]), self.k)

    def floor(self) -> np.ndarray:
        """The k-th best score of each slot, ``NONE`` where there are fewer."""
        out = np.full(self.slots, NONE)
        last = np.arange(len(self.row)) - np.searchsorted(self.row, self.row, "left") == self.k - 1
        out[self.row[last]] = self.score[last]
        return out


def _label_fits(label_lo: np.ndarray, label_hi: np.ndarray, labels: np.ndarray, same: bool) -> np.ndarray:
    """Which zones can hold rows of each anchor's label, or of other labels."""
    own = labels[:, None]
    return (label_lo <= own) & (own <= label_hi) if same else (label_lo != own) | (label_hi != own)


class Shelf:
    """The blocks of one shelf, of one length of vectors."""

    def __init__(self, dim: int, rows: list[tuple[pa.RecordBatch, int]]):
        def lists(name: str) -> list[np.ndarray]:
            return [b.column(name)[i].values.to_numpy().astype(np.int64) for b, i in rows]

        ids = lists("ids")
        self.blocks = list(zip(ids, lists("labels"), [x.reshape(len(i), dim) for i, x in zip(ids, lists("vectors"), strict=True)], strict=True))
        self.lows, self.highs = (np.array(lists(c)).reshape(len(ids), dim) for c in ("lo", "hi"))
        self.label_lo, self.label_hi = (np.array([b.column(c)[i].as_py() for b, i in rows]) for c in ("label_lo", "label_hi"))

    def search(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, slot_of: np.ndarray, least: np.ndarray,
               most: np.ndarray, same: bool, k: int) -> Best:
        """The best ``k`` rows of each slot, a window of scores (``least`` to ``most``) of the anchor ``slot_of``:
        rows of its label and another id, or with ``same`` false rows of other labels."""
        low, high = bounds(vectors, self.lows, self.highs)
        fits = _label_fits(self.label_lo, self.label_hi, labels, same)
        found = Best(len(slot_of), k)
        for n in np.argsort(-high.max(axis=0), kind="stable"):
            reads = fits[slot_of, n] & (high[slot_of, n] >= np.maximum(least, found.floor())) & (low[slot_of, n] <= most)
            slots = np.flatnonzero(reads)
            if not len(slots):
                continue
            block_ids, block_labels, block_vectors = self.blocks[n]
            asked, at = np.unique(slot_of[slots], return_inverse=True)
            scores = product(vectors[asked], block_vectors)
            if same:
                fine = (block_labels[None, :] == labels[asked, None]) & (block_ids[None, :] != ids[asked, None])
            else:
                fine = block_labels[None, :] != labels[asked, None]
            scores[~fine] = NONE
            scores = scores[at]
            scores[(scores < least[slots, None]) | (scores > most[slots, None])] = NONE
            row, score, row_ids = best_rows(scores, block_ids, k)
            found.add(slots[row], score, row_ids)
        return found


# Spark

BLOCK = "shelf int, dim int, ids array<long>, labels array<long>, vectors array<int>, lo array<int>, hi array<int>, label_lo long, label_hi long"
ANCHOR = "akey long, id long, label long, v array<int>, least array<long>, most array<long>"
FOUND = "akey long, slot int, id long, score long"
_KINDS = dict(c.split() for c in f"{BLOCK}, {ANCHOR}".split(", "))
_BLOCK, _ANCHOR = ([c.split()[0] for c in x.split(", ")] for x in (BLOCK, ANCHOR))


def usable(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(``id``, ``label``, ``v``: integer components) of the rows that take part, equal rows once."""
    fine = F.forall("x", lambda c: F.coalesce(F.abs(c * scale) < float(LARGEST), F.lit(False)))  # neither NULL nor NaN is less
    return (df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                      F.col(vector_col).cast("array<double>").alias("x"))
            .where("id is not null and label is not null and x is not null").where(fine)
            .select("id", "label", F.transform("x", lambda c: F.floor(c * scale).cast("int")).alias("v")).distinct())


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _lists(column: pa.Array) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(column.value_lengths().to_numpy())
    return np.split(flat, ends[:-1])


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(list, place in it) of all entries of lists of these sizes."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _curve(rows: DataFrame) -> tuple[int, tuple[np.ndarray, np.ndarray]]:
    """(length, curve) for the most frequent length, from the vectors first by hash."""
    shapes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = shapes["dim"] if shapes else 0
    if not dim:
        return 0, (np.zeros(0, np.int64), np.zeros((1, 0)))
    most = max(1, min(SAMPLE_ROWS, SHELF_NUMBERS // dim))
    sample = rows.where(F.size("v") == dim).select("v").orderBy(F.xxhash64("v"), "v").limit(most).toArrow().column("v").combine_chunks()
    return dim, fit_curve(_vectors(sample, dim))


def build_blocks(rows: DataFrame, shelf_numbers: int = SHELF_NUMBERS, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """(blocks, shelves): blocks with zone maps, one row each, written once as Parquet in the order of (length, label,
    Hilbert index, id). Vectors of a length other than the most frequent one have no Hilbert index."""
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    shelves = max(1, math.ceil(shape["n"] * max(1, shape["dim"] or 0) / shelf_numbers))
    dim, fitted = _curve(rows)
    curve = rows.sparkSession.sparkContext.broadcast(fitted)  # KEY_BITS dimensions at most

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [b""] * b.num_rows
            here = np.flatnonzero(b.column("dim").to_numpy() == dim)
            if len(here):
                for i, key in zip(here.tolist(), curve_keys(_vectors(b.column("v").take(pa.array(here)), dim), *curve.value), strict=True):
                    keys[i] = key.tobytes()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.binary())], names=[*b.schema.names, "key"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelf = TaskContext.get().partitionId()
        held: list[tuple] = []  # (length, ids, labels, vectors) of rows of one length that wait for their block

        def blocks(least: int) -> Iterator[pa.RecordBatch]:
            """Blocks of what is held, while at least so many rows are."""
            while held and sum(len(p[1]) for p in held) >= least:
                size = held[0][0]
                ids, labels, vectors = (np.concatenate([p[i] for p in held]) for i in (1, 2, 3))
                held[:] = [(size, ids[block_rows:], labels[block_rows:], vectors[block_rows:])] if len(ids) > block_rows else []
                ids, labels, vectors = ids[:block_rows], labels[:block_rows], vectors[:block_rows]
                lists = [pa.array([x], pa.list_(kind)) for x, kind in (
                    (ids, pa.int64()), (labels, pa.int64()), (vectors.ravel(), pa.int32()), (vectors.min(axis=0), pa.int32()), (vectors.max(axis=0), pa.int32()))]
                yield pa.RecordBatch.from_arrays([pa.array([shelf], pa.int32()), pa.array([size], pa.int32()), *lists,
                                                  pa.array([labels.min()]), pa.array([labels.max()])], names=_BLOCK)

        for b in batches:
            sizes, ids, labels = (b.column(c).to_numpy() for c in ("dim", "id", "label"))
            edges = np.flatnonzero(np.diff(sizes, prepend=-1, append=-1))
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if held and held[0][0] != sizes[lo]:
                    yield from blocks(1)
                held.append((int(sizes[lo]), ids[lo:hi], labels[lo:hi], _vectors(b.column("v").slice(lo, hi - lo), int(sizes[lo]))))
                yield from blocks(block_rows)
        yield from blocks(1)

    order = ["dim", "label", "key", "id"]
    keyed = rows.withColumn("dim", F.size("v")).mapInArrow(place, "id long, label long, v array<int>, dim int, key binary")
    return cut_lineage(keyed.repartitionByRange(shelves, *order).sortWithinPartitions(*order).mapInArrow(pack, BLOCK), "hard-blocks"), shelves


def shelf_zones(blocks: DataFrame) -> DataFrame:
    """Zone map of each shelf and length, written once; one row each."""
    ends = (blocks.select("shelf", "dim", "label_lo", "label_hi", F.posexplode_outer(F.arrays_zip("lo", "hi")).alias("i", "x"))
            .groupBy("shelf", "dim", "i").agg(F.min("x.lo").alias("lo"), F.max("x.hi").alias("hi"), F.min("label_lo").alias("label_lo"),
                                              F.max("label_hi").alias("label_hi")))
    listed = F.sort_array(F.collect_list(F.when(F.col("i").isNotNull(), F.struct("i", "lo", "hi"))))
    return cut_lineage(ends.groupBy("shelf", "dim").agg(F.min("label_lo").alias("label_lo"), F.max("label_hi").alias("label_hi"), listed.alias("z"))
                       .select("shelf", "dim", "label_lo", "label_hi", F.col("z.lo").alias("lo"), F.col("z.hi").alias("hi")), "hard-zones")


def _sections(batches: Iterator[pa.RecordBatch], keys: list[str], flag: str) -> Iterator[tuple[list[pa.RecordBatch], pa.RecordBatch]]:
    """Of rows sorted by the keys, those without ``flag`` first: (all of the key's rows without it, some of its rows with it)."""
    now, held = None, []
    for b in batches:
        named = list(zip(*[b.column(c).to_pylist() for c in keys], strict=True))
        flagged = b.column(flag).is_valid().to_pylist()
        lo = 0
        while lo < b.num_rows:
            hi = lo
            while hi < b.num_rows and named[hi] == named[lo] and flagged[hi] == flagged[lo]:
                hi += 1
            if named[lo] != now:
                now, held = named[lo], []
            if flagged[lo]:
                yield held, b.slice(lo, hi - lo)
            else:
                held.append(b.slice(lo, hi - lo))
            lo = hi


def _meet(held: DataFrame, asked: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """Both tables' rows of a key in one task, the held ones first, in common columns."""
    names = [c for c in _KINDS if c in {*held.columns, *asked.columns} - set(keys)]
    both = [df.select(*keys, *[F.col(c) if c in df.columns else F.lit(None).cast(_KINDS[c]).alias(c) for c in names]) for df in (held, asked)]
    return both[0].unionByName(both[1]).repartition(parts, *keys).sortWithinPartitions(*keys, F.col("akey").isNotNull())


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def route(anchors: DataFrame, zones: DataFrame, shelves: int, same: bool) -> DataFrame:
    """(anchor, ``on``: shelf, ``low``, ``high``): the shelves whose bounds meet one of the anchor's windows. The zone maps meet the
    anchors in lots of ``ZONES`` shelves and as many groups of anchors as there are partitions."""
    parts = _parts(anchors)
    lots = math.ceil(shelves / ZONES)
    held = zones.select("*", F.floor(F.col("shelf") / ZONES).cast("int").alias("lot"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("grp"))
    asked = anchors.select("*", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("lot"), F.pmod(F.xxhash64("akey"), F.lit(parts)).cast("int").alias("grp"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ready = None, {}
        for rows, part in _sections(batches, ["lot", "grp"], "akey"):
            if rows is not last:
                last, table = rows, pa.Table.from_batches(rows).combine_chunks() if rows else None
                ready = {}
                for d in (np.unique(table["dim"].to_numpy()).tolist() if rows else ()):
                    z = table.filter(pa.array(table["dim"].to_numpy() == d)).combine_chunks()
                    ready[d] = *(z[c].to_numpy() for c in ("shelf", "label_lo", "label_hi")), *(_vectors(z[c].combine_chunks(), d) for c in ("lo", "hi"))
            sizes, labels = part.column("v").value_lengths().to_numpy(), part.column("label").to_numpy()
            # the hull of the windows decides here; the blocks judge each window
            least = np.array([x.min(initial=np.iinfo(np.int64).max) for x in _lists(part.column("least"))])
            most = np.array([x.max(initial=NONE) for x in _lists(part.column("most"))])
            for d, (shelf, label_lo, label_hi, lows, highs) in ready.items():
                for at in range(0, part.num_rows, STEP):
                    here = at + np.flatnonzero(sizes[at:at + STEP] == d)
                    low, high = bounds(_vectors(part.column("v").take(pa.array(here)), d), lows, highs)
                    fits = _label_fits(label_lo, label_hi, labels[here], same)
                    row, col = np.nonzero(fits & (high >= least[here, None]) & (low <= most[here, None]))
                    for lo in range(0, len(row), 8 * STEP):
                        r, c = row[lo:lo + 8 * STEP], col[lo:lo + 8 * STEP]
                        yield pa.RecordBatch.from_arrays([*part.select(_ANCHOR).take(pa.array(here[r])).columns, pa.array(shelf[c], pa.int32()),
                                                          pa.array(low[r, c]), pa.array(high[r, c])], names=[*_ANCHOR, "on", "low", "high"])

    return _meet(held, asked, ["lot", "grp"], parts).mapInArrow(meet, f"{ANCHOR}, on int, low long, high long")


def read_shelves(blocks: DataFrame, shelves: int, routed: DataFrame, same: bool, k: int, groups: int) -> DataFrame:
    """(``akey``, ``slot``: place of the window, ``id``, ``score``) of the best ``k`` rows of each window in each shelf that
    the anchors are routed to."""
    asked = routed.select(F.col("on").alias("nr"), F.pmod(F.xxhash64("akey"), F.lit(groups)).cast("int").alias("grp"), *_ANCHOR)
    held = blocks.withColumn("nr", F.col("shelf")).join(asked.select("nr", "grp").distinct(), "nr")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ready = None, {}
        for rows, part in _sections(batches, ["nr", "grp"], "akey"):
            if rows is not last:
                last, by_dim = rows, {}
                for b in rows:
                    for i, d in enumerate(b.column("dim").to_pylist()):
                        by_dim.setdefault(d, []).append((b, i))
                ready = {d: Shelf(d, x) for d, x in by_dim.items()}
            sizes = part.column("v").value_lengths().to_numpy()
            for d, shelf in ready.items():
                for at in range(0, part.num_rows, STEP):
                    here = at + np.flatnonzero(sizes[at:at + STEP] == d)
                    if len(here):
                        yield _search(part.take(pa.array(here)), d, shelf, same, k)

    return _meet(held, asked, ["nr", "grp"], max(_parts(blocks), shelves)).mapInArrow(read, FOUND)


def _search(part: pa.RecordBatch, dim: int, shelf: Shelf, same: bool, k: int) -> pa.RecordBatch:
    owner, slot = _spread(part.column("least").value_lengths().to_numpy())
    least, most = (part.column(c).flatten().to_numpy() for c in ("least", "most"))
    best = shelf.search(part.column("id").to_numpy(), part.column("label").to_numpy(), _vectors(part.column("v"), dim), owner, least, most, same, k)
    akey = part.column("akey").to_numpy()[owner[best.row]]
    return pa.RecordBatch.from_arrays([pa.array(akey, pa.int64()), pa.array(slot[best.row], pa.int32()), pa.array(best.ids), pa.array(best.score)],
                                      names=["akey", "slot", "id", "score"])


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("akey", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(blocks: DataFrame, shelves: int, zones: DataFrame, anchors: DataFrame, same: bool, k: int, groups: int) -> DataFrame:
    """(``akey``, ``slot``, ``rank``, ``id``, ``score``) over all shelves in two passes: the most promising shelf of each
    anchor first, then those that can still better or fill a window."""
    routed = cut_lineage(route(anchors, zones, shelves, same), "hard-routes")
    home = routed.withColumn("n", F.row_number().over(Window.partitionBy("akey").orderBy(F.desc("high"), "on"))).where("n = 1").drop("n")
    first = cut_lineage(read_shelves(blocks, shelves, home, same, k, groups), "hard-first")
    floors = (_best(first, k).where(F.col("rank") == k).groupBy("akey")
              .agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("floors")))
    raised = F.transform("least", lambda x, i: F.greatest(x, F.try_element_at("floors", i.cast("int"))))
    rest = (routed.join(home.select("akey", "on"), ["akey", "on"], "left_anti").join(floors, "akey", "left").withColumn("least", raised)
            .where(F.exists(F.arrays_zip("least", "most"), lambda w: (F.col("high") >= w["least"]) & (F.col("low") <= w["most"]))))
    return _best(first.unionByName(read_shelves(blocks, shelves, rest, same, k, groups)), k)


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = 5, negatives: int = 3, least_percent: int = 50, most_percent: int = 95, scale: int = SCALE,
         shelf_numbers: int = SHELF_NUMBERS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``).

    Anchors are the rows for which ``is_anchor``, an expression over ``id`` and ``label``, holds. An anchor's positives are the
    ``positives`` best rows of its label with another id (all, if fewer); each positive gets the first ``negatives`` rows of
    other labels with ``least_percent * positive_score <= 100 * negative_score <= most_percent * positive_score``. Greater scores
    come first, ties by smaller id. A positive of negative score has no such row.

    Rows with a NULL id, label or vector, with a component that is NULL or not finite, or whose scaled component reaches
    ``LARGEST`` (its scores might not fit a long) take no part. Vectors of different lengths are not compared. Rows that agree in
    id, label and vector are one row; other rows of one id are rows of their own, but never each other's positives. An empty
    table gives an empty result. Other columns are ignored."""
    require(df, id_col, vector_col, label_col)
    rows = cut_lineage(usable(df, id_col, vector_col, label_col, scale), "hard-rows")
    blocks, shelves = build_blocks(rows, shelf_numbers, block_rows)
    zones = shelf_zones(blocks)
    anchors = cut_lineage(rows.where(is_anchor).select(F.monotonically_increasing_id().alias("akey"), "id", "label", "v"), "hard-anchors")
    groups = max(1, math.ceil(anchors.count() / ANCHOR_GROUP))
    any_score = anchors.withColumns({"least": F.array(F.lit(NONE + 1)), "most": F.array(F.lit(-(NONE + 1)))})
    good = cut_lineage(search(blocks, shelves, zones, any_score, True, positives, groups)
                       .select("akey", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "hard-positives")
    # whole ends of each window of scores: least rounded up, most rounded down
    windows = (good.where("positive_score >= 0").select("akey", "positive_score").distinct()
               .select("akey", F.struct("positive_score", F.expr(f"(positive_score * {least_percent} + 99) div 100").alias("least"),
                                        F.expr(f"(positive_score * {most_percent}) div 100").alias("most")).alias("w"))
               .groupBy("akey").agg(F.sort_array(F.collect_list("w")).alias("w")))
    asking = cut_lineage(anchors.join(windows, "akey").select(*anchors.columns, F.col("w.least").alias("least"), F.col("w.most").alias("most"),
                                                              F.col("w.positive_score").alias("of")), "hard-windows")
    bad = search(blocks, shelves, zones, asking.drop("of"), False, negatives, groups)
    of = asking.select("akey", F.col("id").alias("anchor_id"), F.posexplode("of").alias("slot", "positive_score"))
    return (bad.join(of, ["akey", "slot"]).join(good, ["akey", "positive_score"])
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


SQL = """
WITH r AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, b.id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.id <> b.id AND len(a.v) = len(b.v) WHERE a.id % 50 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
