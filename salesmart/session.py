"""Session helpers: a session for local runs and the shared scratch location.

Library functions never build their own session; they take the caller's.
Intermediate tables are written under the cluster's shared
``spark.checkpoint.dir`` (read from the session). Only when that setting
is absent, as in local tests, a directory of our own is set.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(
    cpus: int | str = "*", shuffle_partitions: int = 8, app_name: str = "salesmart"
) -> SparkSession:
    """Session for tests and the local benchmark (``local[cpus]``)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "8g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory of the session, set only when absent."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="salesmart-ckpt-")  # one machine: tests, bench
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared checkpoint directory."""
    return f"{checkpoint_root(spark)}/salesmart/{name}-{uuid.uuid4().hex[:12]}"
