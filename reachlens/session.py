"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import re
from collections.abc import Callable

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  AQE re-plans joins from real
# shuffle sizes (runtime broadcast only when the measured side is under the
# threshold), coalesces small shuffle partitions and splits skewed ones.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs a shuffle: otherwise the pair
    # dedupe reuses the join's hash(activity id) partitioning and AQE keeps a
    # hot activity (one notification to a third of all students) in ONE task
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # large bridge scans are pre-filtered by a bloom filter of the windowed
    # activity ids before a sort-merge join shuffles them
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # no per-call Python call-site capture while building plans (driver time)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Static (startup-only) settings among the defaults: a cluster session keeps
# whatever its deployment chose for these.
_STATIC = {"spark.ui.enabled", "spark.ui.showConsoleProgress",
           "spark.python.sql.dataFrameDebugging.enabled"}


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set each runtime default only where the session leaves it unset, so a
    cluster's own ``--conf`` choices win."""
    for key, value in SESSION_DEFAULTS.items():
        if key not in _STATIC and spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "reachlens") -> SparkSession:
    """A local session for tests, the bench and the driver's smoke check."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and tasks are one process on one machine."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def shared_dir(spark: SparkSession, fallback: str | Callable[[], str] | None = None) -> str:
    """The cluster's shared folder for written intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only
    when the session has none and is local - in tests - is ``fallback`` (a
    folder, or what makes one) installed as the checkpoint dir; on a cluster a
    folder of the driver's would be no shared one, so that raises.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    ctx_dir = spark.sparkContext.getCheckpointDir()
    if ctx_dir:
        return ctx_dir.rstrip("/")
    if fallback is None or not is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; pass a shared folder")
    folder = fallback() if callable(fallback) else fallback
    os.makedirs(folder, exist_ok=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")
