"""Session helpers: a tuned local session for tests/bench and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; all are plain Spark configuration keys.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "framewise") -> SparkSession:
    """Session for tests and the bench. On a cluster, use the cluster's own builder."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = (builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster names it in ``spark.checkpoint.dir``; only when it is unset (local
    tests) do we create one, so that ``checkpoint()`` and scratch tables work.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors "
                               "(a machine-local folder is not visible to the cluster)")
        conf_dir = tempfile.mkdtemp(prefix="framewise-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder (never machine-local on a
    cluster), grouped per application so a finished job's scratch can be removed at once."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def local_fs_path(path: str) -> str | None:
    """POSIX path for ``file:`` URIs or plain paths (used by the few steps that write with Python)."""
    if path.startswith("file:"):
        p = path[len("file:"):]
        while p.startswith("//"):
            p = p[1:]
        return p
    if "://" in path:
        return None
    return os.path.abspath(path)


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` once as parquet below the shared checkpoint folder and read it back.

    Like ``checkpoint()`` this ends the lineage (later jobs and task retries after a lost
    executor start from the files), but it computes ``df`` once: ``Dataset.checkpoint``
    counts the data and then recomputes it to write the checkpoint files."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
