"""User functions in Arrow batches, step logs, zipped records, forward fill, published counts."""

import io
import zipfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from framewise.operators import udfs
from framewise.operators.blocked import fill_forward
from framewise.operators.ewm import ewm_mean
from framewise.operators.models import forest_grid_search
from framewise.sources.files import csv_records, read_zipped_csv, write_zipped_csv


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"k": np.where(rng.random(400) < 0.4, "hot", rng.choice(list("abc"), 400)), "t": np.arange(400), "x": rng.normal(size=400)})
    pdf.loc[rng.random(400) < 0.3, "x"] = None
    pdf.loc[:20, "x"] = None
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), "k string, t long, x double").repartition(5), pdf


def test_row_functions_get_batches_or_single_values(frame):
    df, pdf = frame
    out = udfs.apply_rows(df, lambda t, x: t * 2 + x, ["t", "x"], "y", "double")
    out = udfs.apply_rows(out, udfs.each_row(lambda k, t: f"{k}{t}"), ["k", "t"], "s", "string").toPandas().sort_values("t")
    assert np.allclose(out.y, pdf.t * 2 + pdf.x, equal_nan=True)
    assert out.s.tolist() == (pdf.k + pdf.t.astype(str)).tolist()


def test_group_function_by_partial_merge_finish(frame):
    df, pdf = frame
    share = udfs.group_apply(
        df, ["k"], lambda b: b.groupby("k")[["x"]].agg(lambda s: s.abs().sum()).rename(columns={"x": "_a"}), "_a double",
        lambda parts: parts.groupBy("k").agg(F.sum("_a").alias("_a")), lambda b: b["x"].abs() / b["_a"], "share", "double", ["x"])
    got = share.toPandas().sort_values("t")
    assert np.allclose(got.share, pdf.groupby("k").x.transform(lambda s: s.abs() / s.abs().sum()), equal_nan=True)
    with pytest.raises(ValueError, match="clash"):
        udfs.group_apply(df, ["k"], lambda b: b, "x double", lambda parts: parts, lambda b: b["x"], "y", "double")


def test_logged_step_reports_rows_after_the_action(frame):
    df, pdf = frame
    step = udfs.logged("hot only", lambda d: d.where("k = 'hot'"))
    df.transform(step).collect()
    assert step.report() == [(pdf.k == "hot").sum()] and step.observations == []


def test_fill_forward_over_blocks(frame):
    df, pdf = frame
    got = fill_forward(df, ["k"], ["t"], "x", "f", block_rows=7).toPandas().sort_values("t")
    want = pdf.groupby("k").x.ffill()
    assert np.allclose(got.f.astype(float), want, equal_nan=True)
    assert np.allclose(ewm_mean(df, "x", ["t"], ["k"], alpha=1, name="e").toPandas().sort_values("t").e.astype(float), want, equal_nan=True)


def test_zipped_records_keep_quoted_newlines(spark, tmp_path):
    assert list(csv_records(io.StringIO('a,"b\nc"\r\nd\u2028,e\n'))) == ['a,"b\nc"', "d\u2028,e"]
    rows = [(1, 'two\nlines, "quoted"'), (2, "plain")]
    write_zipped_csv(spark.createDataFrame(rows, "i int, s string"), str(tmp_path / "z")).collect()
    got = read_zipped_csv(spark, f"{tmp_path}/z/*.zip", "i INT, s STRING").select("i", "s").collect()
    assert sorted(got)[1] == rows[1] and sorted(got)[0].i == 1 and "two\nlines" in sorted(got)[0].s


def test_zip_members_are_tasks_of_their_own(spark, tmp_path):
    folder = tmp_path / "in é a%20b"
    folder.mkdir()
    for a in range(2):
        with zipfile.ZipFile(folder / f"{a}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.mkdir("sub")
            z.writestr("empty.csv", "")
            z.writestr("header.csv", "i,s\n")
            for m in range(30):
                z.writestr(f"sub/{m}.csv", "i,s\n" + "".join(f"{a * 100_000 + m * 1000 + i},é{i}\n" for i in range(1000)))
    got = read_zipped_csv(spark, str(folder).replace("%", "[%]"), "i INT, s STRING").withColumn("task", F.spark_partition_id())
    assert sorted(r["i"] for r in got.collect()) == [a * 100_000 + i for a in range(2) for i in range(30_000)]
    assert got.where("path like '%0.zip'").select("task").distinct().count() > 1


def test_zip_archives_of_a_task_that_ran_before(spark, tmp_path):
    """A task's second run takes its archive's place; what a dead task left is not read."""
    folder = f"file://{tmp_path}/out"
    df = spark.range(0, 1000, 1, 4).where("id >= 250").withColumn("s", F.lit("x"))
    for _ in range(2):
        done = write_zipped_csv(df, folder).collect()
        assert sum(r["rows"] for r in done) == 750 and len(done) == 3
    (tmp_path / "out" / "_part-dead").write_bytes(b"PK half an archive")
    assert len(list((tmp_path / "out").glob("*.csv.zip"))) == 3
    assert sorted(r["id"] for r in read_zipped_csv(spark, folder, "id BIGINT, s STRING").collect()) == list(range(250, 1000))


def test_trees_deeper_than_sparks_are_refused(spark):
    with pytest.raises(ValueError, match="30"):
        forest_grid_search(spark.createDataFrame([(0, "a", 1.0)], "y int, g string, x double"), "y", ["g"], ["x"], max_depth=[40])
