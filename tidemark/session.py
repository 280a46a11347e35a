"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Rows one task may hold for a single window group before the group is split.
GROUP_ROWS_CONF = "spark.tidemark.maxGroupRows"
GROUP_ROWS_DEFAULT = 5_000_000

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even when the next operator then needs its own shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # of repeated keys in a JSON object the last counts
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Shuffle partitions are left to the cluster; pass
    ``**{"spark.sql.shuffle.partitions": "8"}`` for a local run.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a missing setting is an error, since a machine-local folder would
    be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{unique_name(name)}"


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


def max_group_rows(spark: SparkSession) -> int:
    return int(spark.conf.get(GROUP_ROWS_CONF, str(GROUP_ROWS_DEFAULT)))
