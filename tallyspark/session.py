"""SparkSession construction and lineage cutting.

Cluster settings (executor counts, ``spark.checkpoint.dir``) come from the
environment the job is submitted to.  Only where a value is *unset* — local
runs and tests — do we fill in a default.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Session defaults that matter for these plans.  AQE re-plans joins from
# runtime sizes (broadcast only when the measured side is under the threshold)
# and splits skewed shuffle partitions; both are on by default in Spark 4 but
# are pinned here because the plans rely on them.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # a small, filtered join side (e.g. a month of loans) builds a bloom
    # filter that prunes the large side's scan (e.g. all-history limit loans)
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tallyspark", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SCRATCH_KEY = "tallyspark.scratch.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (a shared file system).  Only
    when it is unset (local runs, tests) do we create a scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        # spark.checkpoint.dir cannot be set on a running session; a local
        # scratch folder is remembered under our own key instead
        current = spark.conf.get(_SCRATCH_KEY, None)
        if not current:
            if not spark.conf.get("spark.master", "local").startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            current = tempfile.mkdtemp(prefix="tallyspark-ckpt-")
            spark.conf.set(_SCRATCH_KEY, current)
    try:  # classic sessions: also the RDD checkpoint folder (for checkpoint())
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
    except Exception:  # noqa: BLE001 — e.g. a Spark Connect session has no SparkContext
        pass
    return current


def checkpoint_path(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "materialized", name)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the Hadoop FileSystem of the path (local, HDFS,
    object stores alike).  Returns False where that API is not reachable
    (e.g. a Spark Connect client)."""
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.delete(hpath, True))
    except Exception:  # noqa: BLE001
        return False


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, through the Hadoop FileSystem of the path."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` as parquet under the checkpoint folder and
    reading it back.  Survives executor loss (unlike a local checkpoint)."""
    spark = df.sparkSession
    path = checkpoint_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    # the schema is the one just written: no footer inference on read-back
    return spark.read.schema(df.schema).parquet(path)
