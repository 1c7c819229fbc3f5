"""n-gram join: partners of one set dealt to cells, blocks over a hash range of very many parts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewise.llm import ngram_join
from helpers import components as brute_components


def _rows():
    rng = random.Random(9)
    base = [f"w{i}" for i in range(70)]
    rows = [(i, " ".join(base[:rng.randint(58, 70)])) for i in range(90)]  # each near its neighbours in length
    rows += [(100 + i, " ".join(f"u{rng.randint(0, 12)}" for _ in range(rng.randint(0, 25)))) for i in range(60)]
    return rows


@pytest.mark.parametrize("partners, part_bytes", [(3, 8 << 20), (512, 16), (3, 16)])
def test_cells_and_many_parts_keep_every_link(spark, monkeypatch, partners, part_bytes):
    monkeypatch.setattr(ngram_join, "PARTNERS", partners)
    monkeypatch.setattr(ngram_join, "PART_BYTES", part_bytes)
    rows = _rows()
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    comp, size = brute_components(rows)
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in got} == {i: (comp[i], size[i]) for i, _ in rows}


def test_partners_of_one_set_reach_many_cells(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PARTNERS", 10)
    rng = np.random.default_rng(1)
    own = np.sort(rng.choice(1 << 40, 80, replace=False)).astype(np.uint64)
    sets = spark.createDataFrame([(i, 80, bytearray(ngram_join.pack(own if i % 2 == 0 else own + np.uint64(i)))) for i in range(401)],
                                 "rep long, n int, tokens binary")
    pairs = spark.createDataFrame([(0, i) for i in range(1, 401)] + [(5, 7), (6, 8)], "u long, v long")
    linked = ngram_join._verify(pairs, sets, 75)
    where = linked.select(F.spark_partition_id().alias("p"), "u", "v").collect()
    assert sorted((r["u"], r["v"]) for r in where) == sorted([(0, i) for i in range(2, 401, 2)] + [(6, 8)])
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        assert len({r["p"] for r in ngram_join._verify(pairs, sets, 75).select(F.spark_partition_id().alias("p")).collect()}) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
