"""Spark session settings and the shared scratch location.

Every operator in the package is a lazy DataFrame transformation; the only
session-level knobs the engine depends on are the ones below.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the operators rely on. All are session-scoped, so they
# can be applied to a session someone else built (the verify driver, a notebook).
RUNTIME_CONF = {
    # Timestamps in the landed data are read and bucketed to years in UTC.
    "spark.sql.session.timeZone": "UTC",
    # The latest-value marts aggregate 2 x (number of indicators) columns in one
    # HashAggregate; 112 fields for the full dictionary exceeds the default of 100
    # and would drop out of whole-stage codegen.
    "spark.sql.codegen.maxFields": "250",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "atlaspanel",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Session builder for scripts and tests.

    On a cluster ``master`` stays None (spark-submit decides) and
    ``shuffle_partitions`` should be sized so one shuffle partition is
    ~128-256 MB of the largest long-points table; AQE coalesces the rest.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it (a path every executor can reach). Only on a local
    master, as in tests, may it be unset: a private temporary folder is then
    created and set. Elsewhere such a folder would be unreadable to the other
    machines, so an unset setting is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    else:
        configured = None
    configured = configured or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="atlaspanel-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, "atlaspanel", f"{name}-{uuid.uuid4().hex[:12]}")
