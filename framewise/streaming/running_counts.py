"""Running counts over files that keep arriving (file-by-file count merge, then top-k).

``readStream`` over a folder picks up new files, as many bytes of them a micro-batch as the
caller allows; the streaming aggregation keeps the per-key counts as RocksDB state, whose
change logs are checkpointed in the shared folder, so a restart or a lost executor resumes
from the last committed batch and the state need not fit in an executor's heap.

Each micro-batch writes only the counts it changed, as a run of its own. Every ``FANOUT``
runs of a level are merged into one run of the next and then removed, so that after n
batches about ``FANOUT`` * log(n) runs are left. The counts of a key only grow, so the
largest is the current one: reading a run twice, or a run together with the merged one,
changes nothing, and a batch repeated after a failure writes the same run again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

FANOUT = 16

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings that a query takes over when it starts; the session's own are put back."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class CountRuns:
    """The runs of changed counts below ``path``: ``level=<l>/run=<r>`` holds the batches
    r * fanout^l to (r + 1) * fanout^l - 1."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("runs are merged two at a time at least")
        self.spark, self.path, self.schema, self.fanout = spark, path.rstrip("/"), schema, fanout
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        self.fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _folder(self, level: int, run: int) -> str:
        return f"{self.path}/level={level}/run={run}"

    def _hadoop(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _complete(self, level: int, run: int) -> bool:
        """Spark's commit leaves the mark last, so a folder with it holds the whole run."""
        return self.fs.exists(self._hadoop(f"{self._folder(level, run)}/_SUCCESS"))

    def _read(self, *folders: str) -> DataFrame:
        key = self.schema.fields[0].name
        return self.spark.read.schema(self.schema).parquet(*folders).groupBy(key).agg(F.max("count").alias("count"))

    def add(self, batch: DataFrame, epoch: int) -> None:
        """Write a batch's counts, then merge every level that this batch completes. If a
        repeated batch was already merged, the merged run is kept."""
        batch.write.mode("overwrite").parquet(self._folder(0, epoch))
        level, done = 0, epoch + 1
        while done % self.fanout == 0:
            done //= self.fanout
            self._merge(level, done - 1)
            level += 1

    def _merge(self, level: int, target: int) -> None:
        parts = range(target * self.fanout, (target + 1) * self.fanout)
        if not self._complete(level + 1, target):
            present = [self._folder(level, r) for r in parts if self._complete(level, r)]
            self._read(*present).write.mode("overwrite").parquet(self._folder(level + 1, target))
        for r in parts:
            self.fs.delete(self._hadoop(self._folder(level, r)), True)

    def folders(self) -> list[str]:
        """The complete runs that are left, in any order."""
        marks = self.fs.globStatus(self._hadoop(f"{self.path}/level=*/run=*/_SUCCESS")) or []
        return [m.getPath().getParent().toString() for m in marks]

    def counts(self) -> DataFrame:
        """(key, ``count``) after the last batch; empty before the first."""
        folders = self.folders()
        return self._read(*folders) if folders else self.spark.createDataFrame([], self.schema)


def running_counts(spark: SparkSession, source_dir: str, schema: StructType, key: str, out_dir: str,
                   checkpoint_dir: str, bytes_per_trigger: int = 1 << 30, fmt: str = "parquet",
                   fanout: int = FANOUT) -> DataFrame:
    """Process every file now in ``source_dir`` (``availableNow``) that no earlier call with
    this ``checkpoint_dir`` has processed, about ``bytes_per_trigger`` of files a micro-batch
    (one file at least), and return the counts table after the last batch. NULL is a key
    like any other."""
    changed = StructType([schema[key], StructField("count", LongType())])
    runs = CountRuns(spark, out_dir, changed, fanout)
    stream = (spark.readStream.schema(schema).format(fmt).option("maxBytesPerTrigger", bytes_per_trigger)
              .load(source_dir))
    counts = stream.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    with session_conf(spark, STATE_CONF):
        q = (counts.writeStream.outputMode("update").foreachBatch(runs.add)
             .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    return runs.counts()
