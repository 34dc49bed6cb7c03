"""Spark session settings the library relies on."""

from __future__ import annotations

import warnings

from pyspark.sql import SparkSession

# Settings every plan assumes. Time zone pins epoch-second conversions;
# AQE re-plans joins from runtime sizes (broadcast only when the measured
# side is under the threshold) and splits skewed shuffle partitions.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def ensure_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ballotlens", extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs. On a cluster, pass the cluster's
    master and a shuffle partition count sized to the data instead."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for key, value in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_session(spark)


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged writes: the cluster's
    ``spark.checkpoint.dir``.

    Only a local session (tests) may leave it unset: then a folder beside the
    session's warehouse is set. On a cluster an unset folder is an error, and a
    ``file:`` folder, which must then be a mount that all executors share, is
    reported."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.sparkContext.master.startswith("local")
    if not current:
        if not local:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        spark.conf.set("spark.checkpoint.dir", current)
    elif not local and (current.startswith("file:") or current.startswith("/")):
        warnings.warn(f"spark.checkpoint.dir is {current}: every executor must see the same files there", stacklevel=2)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current
