"""The pipeline's stages against plain Python, and the registered queries against their SQL."""

import math
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
import corpus_pipeline as cp
from framewise.sources.tables import TABLES
from helpers import awkward, components, strip_lines, words

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_pipeline_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    after = {}
    table = docs
    for name, stage in cp.STAGES:
        table = stage(spark, table, SF)
        after[name] = [r.asDict() for r in table.collect()]
        if name != "mixing":
            assert table.columns == cp.COLUMNS
    lang = {r["doc_id"] for r in after["language_id"]}
    assert lang == {i for i, r in rows.items() if any(c.isalpha() for c in r["text"] or "")}
    ids = sorted(lang)
    want = {i: "\n".join(kept) for i, (_, kept) in zip(ids, strip_lines([rows[i]["text"] for i in ids], cp.LINE_DOCUMENTS), strict=True)}
    assert {r["doc_id"]: r["text"] for r in after["line_dedup"]} == want
    comp, _ = components(list(want.items()))
    assert {r["doc_id"] for r in after["ngram_join"]} == set(comp.values())
    bench = [" ".join(words(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {i for i in set(comp.values()) if any(b in " ".join(words(want[i])) for b in bench)}
    left = {r["doc_id"] for r in after["decontamination"]}
    assert whole and not whole & left and len(set(comp.values()) - whole - left) <= 3
    mixed = after["mixing"]
    assert {r["doc_id"] for r in mixed} <= left and max(r["copy"] for r in mixed) <= 3
    total = sum(len(words(r["text"])) for r in after["decontamination"])
    assert abs(sum(r["size"] for r in mixed) - total) < 0.1 * total
    ran = cp.run(spark, SF)
    assert sorted((r["doc_id"], r["copy"]) for r in ran.collect()) == sorted((r["doc_id"], r["copy"]) for r in mixed)


def test_stages_take_awkward_and_empty_tables(spark):
    df, _ = awkward(spark)
    for _, stage in cp.STAGES:
        assert stage(spark, df, SF).count() >= 1
        assert stage(spark, df.limit(0), SF).count() == 0
    no_labels = df.withColumn("lang", F.lit(None).cast("string"))
    assert cp.identify_language(spark, no_labels, SF).count() > 0


def _value(v):
    return None if v is None else round(v, 6) if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("key", ["op2_mix_sources", "op5_format_chats", "op7_drop_common_lines", "op8_scan_secrets"])
def test_query_matches_sql(spark, key):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = entry_mod.queries()[key](spark, SF)
    want = con.sql(entry_mod.oracle_sql()[key])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    order = lambda rows: sorted(rows, key=repr)
    assert order(tuple(_value(r[c]) for c in names) for r in got.collect()) == order(
        tuple(_value(v) for v in r) for r in want.select(*names).fetchall())


def test_all_ten_and_the_pipeline_are_registered():
    keys = entry_mod.queries()
    assert "pipeline" in keys and all(sum(k.startswith(f"op{n}_") for k in keys) == 1 for n in range(1, 11))
