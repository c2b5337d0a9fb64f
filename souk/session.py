"""Session construction and the shared work folder.

Jobs never write to a machine-local temporary folder: scratch output goes
under the shared folder the cluster names in ``spark.checkpoint.dir``.  A
folder is set here only when the session has none (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults sized for local[N]; on a cluster the caller's spark-defaults win
# because getOrCreate() keeps an existing session's settings.
_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "souk", extra: dict | None = None) -> SparkSession:
    """Return a session; local defaults apply only when ``master`` is local."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            for k, v in _LOCAL_CONF.items():
                builder = builder.config(k, v)
            if memory := os.environ.get("SOUK_DRIVER_MEMORY"):
                builder = builder.config("spark.driver.memory", memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  With a local master (tests) one is made when neither is
    set; on a cluster that is an error, as no folder would be shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if root:
        if not current:
            spark.sparkContext.setCheckpointDir(root)
        return root
    if current:
        return current
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="souk-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/souk-work/{name}-{uuid.uuid4().hex[:12]}"
