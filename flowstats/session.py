"""Spark session settings for the reports.

On a cluster the session comes from the deployment and its settings win;
these are the settings used for the sessions built here (tests, bench).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    # Adaptive execution: coalesces small shuffle partitions, splits skewed
    # ones, and switches a join to broadcast only when the measured side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# PySpark's per-call Python call-site capture costs several JVM round trips
# for every Column operation while a plan is built; it only adds context to
# error messages.
BUILD_DEFAULTS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "flowstats") -> SparkSession:
    """A local session for tests and benchmarks (UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("FLOWSTATS_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**DEFAULTS, **BUILD_DEFAULTS}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_dir: str | None = None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables, from `spark.checkpoint.dir`.

    Only a session in one local process (tests) may have none: it gets a fresh
    local folder, kept for the life of the process. On a cluster a machine-local
    folder would not be shared, so a missing setting is an error there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    if _local_dir is None:
        globals()["_local_dir"] = tempfile.mkdtemp(prefix="flowstats-ckpt-")
        spark.sparkContext.setCheckpointDir(_local_dir)
    return _local_dir
