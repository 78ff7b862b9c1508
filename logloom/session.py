"""Spark session helpers.

The library never hard-codes cluster sizing: on a cluster the session comes
from the platform and only the settings below that are *unset* get a value.
Tests and the bench build a local session through :func:`local_session`.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. They are only applied when the session does not
# already define them, so a cluster's own tuning always wins.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Bloom filters of a join's smaller side on the scan of the other: also where
    # that side is too large to broadcast (the filter itself stays below 8 MB)
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "4g",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
}


# For the wide decoders: the JVM compiles no method of more than 8,000 bytes, and the
# stages generated for many arguments have longer ones, which would run interpreted.
# Above the limit Spark generates code per operator.
DECODE_DEFAULTS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def apply_defaults(spark: SparkSession, defaults: dict[str, str] = DEFAULTS) -> SparkSession:
    for key, value in defaults.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "logloom") -> SparkSession:
    """A local session for tests and the bench (UI off, no server opened)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LOGLOOM_DRIVER_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is (and
    is required). Only in local mode, when it is unset (tests), a scratch
    folder is created for it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's "
                               "distributed file system); a machine-local folder would not survive "
                               "the loss of an executor")
        path = tempfile.mkdtemp(prefix="logloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: cuts
    the lineage, survives the loss of executors and tells the planner its size
    (a checkpoint's size is unknown, so it is never broadcast)."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
