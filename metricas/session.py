"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Every date/time expression in the library is written so it does not depend
# on the session time zone, except for rendering TimestampType values; pin UTC
# so rendered instants match what the oracle writes.
SESSION_TZ = "UTC"


def pin_utc(spark: SparkSession) -> SparkSession:
    if spark.conf.get("spark.sql.session.timeZone", None) != SESSION_TZ:
        spark.conf.set("spark.sql.session.timeZone", SESSION_TZ)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "metricas") -> SparkSession:
    """Session for tests and the local bench (never used on a cluster)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", SESSION_TZ)
        # plan construction: skip recording Python call sites for every Column call
        # (four JVM round trips each); only error messages lose that context
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("METRICAS_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is respected as is; it is
    an error there if it is unset, since each executor would write to its own
    disk. In local mode (tests, bench) a scratch folder is created instead.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="metricas-ckpt-")
    sc.setCheckpointDir(scratch)
    return scratch


# Settings a cluster deployment is expected to carry (spark-defaults or submit
# flags); listed here so the jobs' assumptions are written down in one place.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": SESSION_TZ,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # initial shuffle width for ~100 TB inputs; AQE coalesces small partitions
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # core setting (spark-submit only): remove checkpoint files of merged runs once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def apply_cluster_conf(spark: SparkSession) -> SparkSession:
    """Set the entries of ``CLUSTER_CONF`` the deployment did not set explicitly."""
    explicit = spark.conf.getAll
    for k, v in CLUSTER_CONF.items():
        if k not in explicit and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    return spark
