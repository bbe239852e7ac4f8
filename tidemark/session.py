"""Session helpers for tests, the bench and command-line use.

Library operators never set session configuration themselves: partition counts,
broadcast thresholds and AQE belong to whoever owns the cluster. Only the local
session built here pins values, and only those a test needs to be repeatable.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cores_of(master: str) -> str:
    """The thread count of a ``local``/``local[N]``/``local[*]`` master string."""
    m = re.fullmatch(r"local(?:\[(\*|\d+)\])?", master.strip())
    if not m:
        raise ValueError(f"only local masters are built here, got {master!r}; use spark-submit otherwise")
    return m.group(1) or "1"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is respected
    as is. A machine-local folder is only ever chosen here, for sessions whose
    driver and executors are one process; any other session must name one.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(?:\[[^\]]*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(local)
    return local
