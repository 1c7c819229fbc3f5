"""Hand-made fixtures for cases the driver tables lack (NULLs, edges, DST, HTML tables)."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from framewise.functions import dates as D
from framewise.functions import text as Tx
from framewise.functions.numeric import great_circle
from framewise.operators import joins as J
from framewise.operators import reshape as Rs
from framewise.operators.filters import date_label_range
from framewise.operators.plotdata import kde
from framewise.sources.files import html_table_rows


def test_flight_times(spark):
    df = spark.createDataFrame([("2017-01-01", t) for t in ["914.0", "5", "2400", None, "12345"]], "d string, t string")
    got = [r.ts for r in df.select(D.hhmm_to_timestamp("d", "t").alias("ts")).collect()]
    assert got == [dt.datetime(2017, 1, 1, 9, 14), dt.datetime(2017, 1, 1, 0, 5), None, None, None]


def test_city_extract_and_pad(spark):
    df = spark.createDataFrame([("Chicago, IL",), ("Guam",)], "c string")
    assert [r.x for r in df.select(Tx.extract("c", r"(.*), \w{2}").alias("x")).collect()] == ["Chicago", None]
    df = spark.createDataFrame([("5",), ("12345",)], "t string")
    assert [r.p for r in df.select(Tx.pad_left("t", 4).alias("p")).collect()] == ["0005", "12345"]


def test_weekday_date_and_offsets(spark):
    df = spark.createDataFrame([("Tue, Oct 27, 2015",), (None,)], "s string")
    assert [r.d for r in df.select(D.parse_date_weekday("s").alias("d")).collect()] == [dt.datetime(2015, 10, 27), None]
    df = spark.createDataFrame([(dt.datetime(2008, 11, 30),)], "t timestamp_ntz")
    assert df.select(D.add_offset("t", months=3, days=-2).alias("x")).first().x == dt.datetime(2009, 2, 26)
    y = spark.createDataFrame([(2015,)], "y int")
    assert y.select(D.nth_weekday_of_month(F.col("y"), 10, "MON", 2).alias("d")).first().d == dt.date(2015, 10, 12)


def test_dst_ambiguous_hour(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 11, 1, 1, 30),)], "t timestamp_ntz")
    assert df.select(D.localize_to_utc("t", "US/Eastern").alias("u")).first().u == dt.datetime(2020, 11, 1, 5, 30)


def test_cut_edges(spark):
    df = spark.createDataFrame([(x,) for x in [1.0, 18.0, 40.0, 80.0, 81.0]], "x double")
    got = [r.b for r in df.select(Rs.bin_cut("x", [1, 18, 40, 80], ["a", "b", "c"]).alias("b")).collect()]
    assert got == [None, "a", "b", "c", None]


def test_align_fill_and_divide(spark):
    a = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, x double")
    b = spark.createDataFrame([("b", 4.0), ("c", 5.0), ("d", 0.0)], "k string, y double")
    got = {r.k: r.r for r in J.align_op(a, b, ["k"], "x", "y", "div", "r", fill_value=1).collect()}
    assert got == {"a": 1.0, "b": 0.5, "c": 0.2, "d": None}
    got = {r.k: r.r for r in J.align_op(a, b, ["k"], "x", "y", "div", "r").collect()}
    assert got == {"a": None, "b": 0.5, "c": None, "d": None}


def test_null_safe_join(spark):
    l = spark.createDataFrame([(None, 1), (1, 2)], "k long, a long")
    r = spark.createDataFrame([(None, 10), (1, 20)], "k long, b long")
    assert J.join(l, r, ["k"]).count() == 1
    assert J.join(l, r, ["k"], null_safe=True).count() == 2


def test_date_labels():
    assert date_label_range("2011", "2016") == (dt.datetime(2011, 1, 1), dt.datetime(2017, 1, 1))
    assert date_label_range("2012-02") == (dt.datetime(2012, 2, 1), dt.datetime(2012, 3, 1))


def html_rows(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "row_id long, html string")
    got = html_table_rows(df, "html", ["row_id"])
    assert got.columns == ["row_id", "table", "row", "cells"]
    return sorted(tuple(r) for r in got.collect())


def test_html_table_rows(spark):
    html = "<table><tr><th>Date</th><th>Pts</th></tr><tr><td>Tue, Oct 27</td><td>97 &amp; up</td></tr></table>"
    assert html_rows(spark, [html]) == [(0, 0, 0, ["Date", "Pts"]), (0, 0, 1, ["Tue, Oct 27", "97 & up"])]


def test_html_tables_nested_spanning_and_unclosed(spark):
    nested = "<TABLE class='a>b'><tr><td>x<table><tr><td>in<td>ner</tr></table>y</td><td>z</td></tr></table><table><tr><td>2</table>"
    spans = ("<table><tr><th rowspan=2>k<th colspan='2'>v</tr><tr><td>a<td>b<tr><td rowspan=\"9\">c<td colspan=0>d"
             "<tr><td>e</td></tr><tr></tr></table>")
    unclosed = "text <td>outside</td><!-- <table><tr><td>no --><table><tbody><td>a <b>b</b><br>c<tr><td>&lt;d&gt;<script>'<td>'</script> 1 < 2"
    assert html_rows(spark, [nested, spans, unclosed, None, "", "<p>none</p>"]) == [
        (0, 0, 0, ["xinnery", "z"]), (0, 1, 0, ["in", "ner"]), (0, 2, 0, ["2"]),
        (1, 0, 0, ["k", "v", "v"]), (1, 0, 1, ["k", "a", "b"]), (1, 0, 2, ["c", "d"]), (1, 0, 3, ["c", "e"]), (1, 0, 4, ["c"]),
        (2, 0, 0, ["a b c"]), (2, 0, 1, ["<d> 1 < 2"])]


def test_html_tables_of_long_pages_and_deep_nesting(spark):
    long = "<table>" + "".join(f"<tr><td>{i}<td>x" for i in range(30_000))
    deep = "<table><tr><td>a" * 200
    got = html_rows(spark, [long, deep])
    assert [r[3] for r in got if r[0] == 0] == [[str(i), "x"] for i in range(30_000)]
    assert [(r[1], len(r[3][0])) for r in got if r[0] == 1] == [(i, 200 - i) for i in range(200)]


def test_json_normalize_nested(spark):
    df = spark.createDataFrame([(1, '{"id": "a", "geometry": {"type": "Point", "coordinates": [1.5, 2.5]}}'),
                                (2, '{"id": "b"}')], "n long, j string")
    out = Rs.json_normalize(df, "j", "id STRING, geometry STRUCT<type: STRING, coordinates: ARRAY<DOUBLE>>")
    assert out.columns == ["n", "id", "geometry.type", "geometry.coordinates"]
    assert [tuple(r) for r in out.orderBy("n").collect()] == [(1, "a", "Point", [1.5, 2.5]), (2, "b", None, None)]


def test_json_normalize_without_a_schema(spark):
    df = spark.createDataFrame([
        (1, '{"id": 1, "geo": {"type": "Point", "at": [1.5, 2]}, "mixed": 1, "none": null, "empty": {}}'),
        (2, '{"id": 2.5, "geo": {"odd `name": "x", "a.b": true}, "mixed": {"y": [2]}}'),
        (3, "not json"), (4, None), (5, "[1]"), (6, '{"id": null, "geo": 7}'), (7, "{}"), (1, '{"id": 3000000000}')], "n long, j string")
    with_geo = Rs.json_normalize_variant(df.where("n != 6"), "j")
    assert with_geo.columns == ["n", "geo.a.b", "geo.at", "geo.odd `name", "geo.type", "id", "mixed", "none"]
    nothing = (None,) * 7
    assert sorted(map(tuple, with_geo.collect()), key=str) == sorted([
        (1, None, [1.5, 2.0], None, "Point", 1.0, "1", None), (2, True, None, "x", None, 2.5, '{"y":[2]}', None),
        (3,) + nothing, (4,) + nothing, (5,) + nothing, (7,) + nothing, (1, None, None, None, None, 3e9, None, None)], key=str)
    whole = Rs.json_normalize_variant(df.where("n in (2, 6)"), "j")   # geo is an object once and a number once
    assert [tuple(r) for r in whole.orderBy("n").collect()] == [
        (2, '{"a.b":true,"odd `name":"x"}', 2.5, [2]), (6, "7", None, None)]


def test_json_normalize_without_records_or_with_clashes(spark):
    df = spark.createDataFrame([(1, "[1]"), (2, None)], "n long, j string")
    assert Rs.json_normalize_variant(df, "j").columns == ["n"]
    assert Rs.json_normalize_variant(df.limit(0), "j").count() == 0
    clash = spark.createDataFrame([(1, '{"N": 1}')], "n long, j string")
    with pytest.raises(ValueError, match="two columns"):
        Rs.json_normalize_variant(clash, "j")
    with pytest.raises(ValueError, match="declare"):
        Rs.json_normalize_variant(spark.createDataFrame([('{"a": 1, "b": 2}',)], "j string"), "j", max_fields=1)


def test_great_circle_identical_points(spark):
    df = spark.createDataFrame([(41.9, -87.6, 41.9, -87.6), (0.0, 0.0, 0.0, 90.0)], "a double, b double, c double, d double")
    got = [r.x for r in df.select(great_circle("a", "b", "c", "d").alias("x")).collect()]
    assert got[0] == 0.0 and abs(got[1] - 6373 * np.pi / 2) < 1e-9


def test_kde_matches_numpy(spark):
    xs = np.array([1.0, 2.0, 2.0, 3.5, 7.0])
    df = spark.createDataFrame(pd.DataFrame({"v": xs}))
    got = kde(df, "v", 5).toPandas().sort_values("point")
    h = xs.std(ddof=1) * len(xs) ** -0.2
    grid = np.linspace(xs.min(), xs.max(), 5)
    exp = [np.exp(-0.5 * ((g - xs) / h) ** 2).sum() / (len(xs) * h * np.sqrt(2 * np.pi)) for g in grid]
    np.testing.assert_allclose(got.density.values, exp, rtol=1e-12)


def test_hours_by_key_take_any_number_of_categories(spark, tmp_path):
    from framewise.plans import registry
    rows = spark.range(10_001).selectExpr("timestamp'2024-01-01 00:30:00' + make_interval(0, 0, 0, 0, cast(id % 2 * 2 as int)) AS ts",
                                          "concat('k', id) AS event_type", "IF(id < 4, 301.0D, 1.0D) AS value")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    got = registry.queries()["resample_hour_by_key"](spark, str(tmp_path)).collect()
    assert len(got) == 3 * 10_001
    assert sorted((r["event_type"], r["hour"].hour) for r in got if r["n"]) == [("k0", 0), ("k1", 2), ("k2", 0), ("k3", 2)]
