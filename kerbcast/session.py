"""Session settings the jobs rely on.

Only semantic settings and adaptive execution are fixed here.  Shuffle partitions,
memory and the checkpoint folder belong to the cluster and are left as found.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "kerbcast", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the one the cluster names, else (local runs
    and tests only) a fresh one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        named = context.getCheckpointDir() or tempfile.mkdtemp(prefix="kerbcast-ckpt-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder, removed when the application ends."""
    path = f"{ensure_checkpoint_dir(spark)}/kerbcast-{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def settle(df: DataFrame) -> DataFrame:
    """Write a reduced table to the checkpoint folder and go on from the files.

    For small results of large scans that several later steps read: they neither repeat
    the scan nor lose it with an executor, as a cached copy would be.  A written table is
    computed once; ``checkpoint()`` computes its rows twice.
    """
    path = shared_folder(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
