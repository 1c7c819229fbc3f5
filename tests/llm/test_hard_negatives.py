"""Hard negatives against all scores, the Hilbert order against its definition, bounds against samples."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewise.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, v string, akey int"


def brute(rows, is_anchor, positives=5, negatives=3):
    """``rows``: (id, vector, label) that take part, without repeats."""
    out = []
    for a, x, lab in rows:
        if not is_anchor(a):
            continue
        near = sorted((-int(np.dot(x, y)), b, m) for b, y, m in rows if len(y) == len(x))
        for s, p, _ in [r for r in near if r[2] == lab and r[1] != a][:positives]:
            ok = [(n, b) for n, b, m in near if m != lab and 50 * -s <= 100 * -n <= 95 * -s][:negatives]
            out += [(a, p, i + 1, b, -s, -n) for i, (n, b) in enumerate(ok)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)
    got = hn.mine(df, F.col("id") % 10 == 0, **kw).collect()
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in got)


def whole(rows, scale=256):
    seen = {(i, lab, tuple(math.floor(scale * c) for c in v)) for i, v, lab in rows if i is not None and v is not None and lab is not None
            and all(c is not None and math.isfinite(c) for c in v)}
    return [(i, np.array(v, np.int64), lab) for i, lab, v in seen]


@pytest.mark.parametrize("bits,dims", [(1, 2), (3, 2), (2, 3), (2, 4)])
def test_hilbert_steps_are_neighbours(bits, dims):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
    keys = [k.tobytes() for k in hn.hilbert_key(grid, bits)]
    assert len(set(keys)) == len(keys)
    path = grid[np.argsort(np.array(keys, dtype="S16"), kind="stable")] if bits * dims % 8 == 0 else grid[sorted(range(len(keys)), key=keys.__getitem__)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_all_products():
    rng = np.random.default_rng(1)
    block, asked = rng.integers(-50, 50, (30, 6)), rng.integers(-50, 50, (10, 6))
    low, high = hn.bounds(asked, block.min(axis=0)[None], block.max(axis=0)[None])
    scores = hn.product(asked, block)
    assert (scores == asked @ block.T).all() and (low[:, 0] <= scores.min(axis=1)).all() and (high[:, 0] >= scores.max(axis=1)).all()
    big = rng.integers(-(1 << 22), 1 << 22, (5, 6))
    assert (hn.product(big, big * 2) == big @ (big * 2).T).all()


def test_bounds_choose_few_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.integers(-200, 200, (20, 8))
    asked = centres[:4]
    blocks = []
    for n, c in enumerate(centres):
        v = c + rng.integers(-5, 5, (50, 8))
        batch = hn.pa.RecordBatch.from_pylist([{"ids": list(range(50 * n, 50 * n + 50)), "labels": [1] * 50, "vectors": v.ravel().tolist(),
                                                "lo": v.min(axis=0).tolist(), "hi": v.max(axis=0).tolist(), "label_lo": 1, "label_hi": 1}])
        blocks.append((batch, 0))
    read = []
    true_product = hn.product
    monkeypatch.setattr(hn, "product", lambda a, b: (read.append(len(a)) if b.shape[0] == 50 else None) or true_product(a, b))
    shelf = hn.Shelf(8, blocks)
    at = np.arange(4)
    hull = np.full(4, hn.NONE + 1), np.full(4, -(hn.NONE + 1))
    best = shelf.search(np.full(4, -1), np.full(4, 1), asked, at, *hull, True, 5)
    assert sum(read) < 4 * 20 / 2
    every = np.concatenate([b[2] for b in shelf.blocks])
    assert (best.score.reshape(4, 5) == -np.sort(-(asked @ every.T), axis=1)[:, :5]).all()


def test_mines_as_all_scores_do(spark):
    rng = np.random.default_rng(12)
    v = np.concatenate([rng.standard_normal((150, 8)) / 3, np.repeat(rng.standard_normal((10, 8)) / 3, 8, axis=0) + rng.integers(0, 2, (80, 8)) / 256])
    labels = np.where(rng.random(230) < 0.4, 3, rng.integers(0, 9, 230))  # one label holds more than a third
    rows = [(i, x.tolist(), int(lab)) for i, (x, lab) in enumerate(zip(v, labels, strict=True))]
    want = brute(whole(rows), lambda i: i % 10 == 0)
    assert len(want) > 100
    assert run(spark, rows) == want
    assert run(spark, rows, shelf_numbers=200, block_rows=7) == want


def test_mines_awkward_rows(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.integers(0, 3, 3) / 4).tolist(), int(i % 40 > 25)) for i in range(90)]  # ties
    rows += [(200 + i, [float(i), 1.0], i % 3) for i in range(12)]  # another length
    rows += [(300, [], 0), (310, [], 1), (320, [0.0, 0.0, 0.0], 0)]
    rows += rows[:20] + [(10, [0.5, 0.25, 0.0], 1), (10, [0.25, 0.25, 0.0], 0)]  # repeated rows, ids on several rows
    rows += [(400, None, 0), (410, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 0), (420, [float("nan"), 1.0, 1.0], 0),
             (430, [float("inf"), 1.0, 1.0], 0), (440, [None, 1.0, 1.0], 0), (450, [1e9, 1.0, 1.0], 0)]
    fit = [r for r in whole(rows) if not len(r[1]) or abs(r[1]).max() < hn.LARGEST]
    want = brute(fit, lambda i: i % 10 == 0)
    monkeypatch.setattr(hn, "ZONES", 3)
    monkeypatch.setattr(hn, "ANCHOR_GROUP", 4)
    assert run(spark, rows, shelf_numbers=60, block_rows=5) == want
    many = [(i, [1.0 + i / 256, 0.5], i // 2) for i in range(60)]  # labels of two rows each
    assert run(spark, many, shelf_numbers=30, block_rows=4) == brute(whole(many), lambda i: i % 10 == 0)
    assert run(spark, []) == []
    assert run(spark, [(7, [1.0], 1)]) == []
