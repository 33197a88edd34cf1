"""Spark session helpers.

A key that spark-submit, spark-defaults or a running session already defines is
left as it is; the defaults below only fill in what nobody has set. The same code
thus runs on ``local[8]`` and on a large cluster with the cluster's own sizing.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Defaults used only when the session does not already define the key.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "metricyard",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the jobs rely on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    running = SparkSession.getActiveSession()
    given = running.sparkContext.getConf() if running else SparkConf()
    for key, value in _DEFAULTS.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the operator and must be on shared
    storage; an unset key is an error there, because every machine would write to
    its own disk. Only a local session, which is one machine, gets a private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="metricyard-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df):
    """``df`` written as Parquet into the shared checkpoint folder and read back: its plan runs once, lineage ends
    there, later reads take only the columns they need, and a lost executor costs no recomputation."""
    folder = ensure_checkpoint_dir(df.sparkSession)
    path = f"{folder.rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
