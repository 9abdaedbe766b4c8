"""Session construction and shared-storage settings.

Everything here is plain Spark configuration.  On a cluster the session is
created by the platform; :func:`configure` only fills in settings that are
unset, so cluster-wide values win; only the session time zone is always UTC.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults chosen for a large cluster; a local test session overrides the
# partition counts.  AQE re-plans joins at runtime (broadcast switch, skew
# split, partition coalescing), so the static numbers are only starting points.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    # semi-join reduction: a selective filter on one join side becomes a
    # bloom filter on the other side's scan before the shuffle
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.ui.enabled": "false",
}

# Settings for ~100 TB inputs on ~1000 executors.  AQE can only coalesce
# shuffle partitions, never split them, so the initial count must be large
# enough that a partition fits in an executor task (~128-256 MB).
LARGE_CLUSTER = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.files.openCostInBytes": "8m",
    "spark.shuffle.service.enabled": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
}


def build_session(master: str | None = None, app: str = "shardcraft",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, profile: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults applied.
    ``profile="large"`` adds :data:`LARGE_CLUSTER`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(CLUSTER_DEFAULTS)
    if profile == "large":
        conf.update(LARGE_CLUSTER)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply engine defaults that the session does not set yet."""
    for k, v in CLUSTER_DEFAULTS.items():
        if k.startswith("spark.ui"):
            continue
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the platform to a shared file system.
    Only when it is unset (local tests) a private scratch folder is created.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; on a cluster it must name a "
                               "shared folder that every executor can read")
        d = tempfile.mkdtemp(prefix="shardcraft-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables, under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex}"
