"""Running counts: many small files, merged runs, restarts, repeated batches."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from framewise.streaming import running_counts as R

SCHEMA = StructType([StructField("k", LongType()), StructField("x", LongType())])


def files(spark, path, n_files, start=0, mode="append"):
    rows = spark.range(start, start + n_files * 7, 1, n_files).select(
        F.when(F.col("id") % 11 != 0, F.col("id") % 11).alias("k"), F.col("id").alias("x"))
    rows.write.mode(mode).parquet(path)


def expected(spark, path):
    return sorted(tuple(r) for r in spark.read.schema(SCHEMA).parquet(path).groupBy("k").count().fillna(-1).collect())


def got(df):
    return sorted(tuple(r) for r in df.fillna(-1).collect())


def run(spark, base, size, fanout=2):
    return R.running_counts(spark, f"{base}/in", SCHEMA, "k", f"{base}/out", f"{base}/ckpt", size, fanout=fanout)


def test_many_small_files_come_in_few_batches(spark, tmp_path):
    files(spark, f"{tmp_path}/in", 300)
    assert got(run(spark, tmp_path, 1 << 30)) == expected(spark, f"{tmp_path}/in")
    assert len(R.CountRuns(spark, f"{tmp_path}/out", SCHEMA).folders()) == 1


def test_runs_are_merged_and_a_restart_goes_on(spark, tmp_path):
    files(spark, f"{tmp_path}/in", 5)
    assert got(run(spark, tmp_path, 1)) == expected(spark, f"{tmp_path}/in")   # a file a batch
    runs = R.CountRuns(spark, f"{tmp_path}/out", SCHEMA, 2)
    assert sorted(f.split("/out/")[1] for f in runs.folders()) == ["level=0/run=4", "level=2/run=0"]
    files(spark, f"{tmp_path}/in", 2, start=1000)
    assert got(run(spark, tmp_path, 1)) == expected(spark, f"{tmp_path}/in")
    assert got(run(spark, tmp_path, 1)) == expected(spark, f"{tmp_path}/in")   # nothing new


@pytest.mark.parametrize("fail", ["before the merge", "after the merge"])
def test_a_batch_that_failed_is_repeated(spark, tmp_path, monkeypatch, fail):
    files(spark, f"{tmp_path}/in", 4)
    merge = R.CountRuns._merge

    def broken(self, level, target):
        if fail == "after the merge":
            merge(self, level, target)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(R.CountRuns, "_merge", broken)
        with pytest.raises(StreamingQueryException):
            run(spark, tmp_path, 1)
    assert got(run(spark, tmp_path, 1)) == expected(spark, f"{tmp_path}/in")
    assert [f.split("/out/")[1] for f in R.CountRuns(spark, f"{tmp_path}/out", SCHEMA, 2).folders()] == ["level=2/run=0"]


def test_no_files_and_settings_put_back(spark, tmp_path):
    (tmp_path / "in").mkdir()
    before = {k: spark.conf.get(k, None) for k in R.STATE_CONF}
    assert run(spark, tmp_path, 1 << 30).collect() == []
    assert {k: spark.conf.get(k, None) for k in R.STATE_CONF} == before
