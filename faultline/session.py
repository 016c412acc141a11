"""Session helpers for tests, the bench and local runs.

On a cluster the session is supplied by the caller; nothing here overrides
settings that are already present (``spark.checkpoint.dir`` in particular).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every faultline job expects; all are standard Spark SQL confs.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "faultline", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("FAULTLINE_DRIVER_MEM", "16g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a scratch one only
    when the cluster did not name one (tests, local runs)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: lineage is cut with "
                           "checkpoint() and executors may be lost")
    path = tempfile.mkdtemp(prefix="faultline-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return path
