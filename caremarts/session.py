"""Session construction and cluster-wide settings.

Settings that a deployment or a running session has are left alone: on a real
cluster it owns ``spark.checkpoint.dir``, shuffle sizing and memory.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Settings every caremarts job relies on. Timestamps are stored and compared in
# UTC; AQE re-plans joins from runtime sizes and splits skewed join partitions.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Defaults for a session that this module itself starts. 128 MiB input splits
# and 128 MiB post-shuffle partitions keep a task's working set well inside an
# executor. The number of shuffle partitions is the deployment's: it follows
# from its data and memory, and AQE merges partitions but never makes more.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(
    master: str | None = None,
    app_name: str = "caremarts",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """The active session as it is, or a new one with the defaults and ``conf``.

    Settings that a running session (or spark-defaults, for a new one) already
    has are never replaced, except by ``conf``, which the caller asks for.
    """
    running = SparkSession.getActiveSession()
    if running is not None:
        for key, value in (conf or {}).items():
            if running.conf.isModifiable(key):
                running.conf.set(key, value)
        return configure(running)
    given = SparkConf()
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        if given.get(key) is None:
            builder = builder.config(key, value)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Set what caremarts jobs rely on where the session has not set it.

    The time zone is part of the results (timestamps are UTC), so it alone is
    set in any case.
    """
    own = spark.sparkContext.getConf()
    for key, value in REQUIRED_CONF.items():
        if key == "spark.sql.session.timeZone" or own.get(key) is None:
            spark.conf.set(key, value)
    return spark


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder: later steps read the columns they need.

    A checkpoint would run the last stage twice and keep whole rows, uncompressed.
    """
    spark = df.sparkSession
    try:
        folder = checkpoint_dir(spark)
    except RuntimeError:  # no cluster named a folder: a laptop or a test
        folder = checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="caremarts-checkpoints-"))
    path = f"{folder}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session; only when it is unset
    (tests, a laptop) is ``fallback`` installed and returned. A cluster's
    executors would not see such a folder, so there it is an error.
    """
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if current:
        return current
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is unset and no fallback was given")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
    os.makedirs(fallback, exist_ok=True)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback
