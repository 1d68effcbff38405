"""Spark session defaults and the shared scratch location."""

from __future__ import annotations

import os
import re
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

# Settings every plan in this package relies on.  The session time zone must be
# UTC: commit times are UTC text and all local-time arithmetic is done on
# TIMESTAMP_NTZ values, but a few Spark formatters still consult the zone.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "hourglass",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster leave ``master`` unset so the launcher decides, and size
    ``shuffle_partitions`` to the data (AQE coalesces small ones at run time).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # Runtime SQL settings also apply when the session already existed.
    for key, value in conf.items():
        if key.startswith("spark.sql.") and key != "spark.sql.warehouse.dir":
            try:
                spark.conf.set(key, value)
            except Exception:  # static SQL conf of an existing session
                pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    This is the only place this package writes intermediate tables, so that
    they survive the loss of an executor.  When the setting is absent, a
    session whose executors all live in the driver's process (``local[...]``,
    as in tests) gets a folder of its own; on a cluster an error is raised,
    because a machine-local folder there would lose rows in silence.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hourglass-ckpt-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder below the checkpoint root."""
    return os.path.join(checkpoint_root(spark), f"hourglass-{label}-{uuid.uuid4().hex[:12]}")


def clear_scratch(spark: SparkSession, older_than_hours: float) -> list[str]:
    """Remove the scratch folders that nothing was written to for that long;
    returns their names.  Only folders that ``scratch_path`` named are touched.
    DataFrames that read one of them cannot be read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint_root(spark))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    limit, gone = int((time.time() - older_than_hours * 3600) * 1000), []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if status.isDirectory() and re.fullmatch(r"hourglass-.+-[0-9a-f]{12}", name) and status.getModificationTime() <= limit:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return gone
