"""Session defaults.

Library code never builds its own session; callers pass one in. This helper is
for tests, ``bench.py`` and command-line use. It keeps the Spark UI off, turns
AQE (skew-join splitting, broadcast conversion from measured sizes, partition
coalescing) on, and leaves ``autoBroadcastJoinThreshold`` at
Spark's default so that every broadcast is behind Spark's own size check.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "gradeframe", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    b = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("GRADEFRAME_DRIVER_MEMORY", "16g"))
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SCRATCH: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; nothing of the caller's session is changed.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as is.
    Only in local mode with nothing configured (tests) is a fresh temporary
    folder made, one an application; on a cluster a missing setting is an
    error, because a machine-local folder is not visible to the executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: configure a shared folder "
                           "(HDFS, object store) for checkpoints and derived tables")
    if sc.applicationId not in _SCRATCH:
        _SCRATCH[sc.applicationId] = tempfile.mkdtemp(prefix="gradeframe-scratch-")
    return _SCRATCH[sc.applicationId]


def application_key(spark: SparkSession) -> str:
    """Identity of the running application."""
    return spark.sparkContext.applicationId
