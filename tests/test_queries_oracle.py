"""Every registered query against its SQL in DuckDB, at a scale the driver does not check
(sf0.001), plus the entry smoke test."""

import math
import os

import pytest

import __spark_entry__ as entry_mod
from framewise.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _norm(v):
    import datetime as dt
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, repr(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["event_type", "hour", "n_events", "events_24h"]
    assert df.count() > 0


def test_every_sql_key_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("key", sorted(entry_mod.oracle_sql()))
def test_query_matches_sql(spark, duck, key):
    got = entry_mod.queries()[key](spark, SF).toPandas()
    exp = duck.sql(entry_mod.oracle_sql()[key]).df()
    c1, r1 = _rows(got)
    c2, r2 = _rows(exp)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2
