"""Session construction and cluster-safe scratch locations."""
from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Defaults that matter for every job in this package.  Shuffle partitions are
# a starting point only: AQE coalesces small partitions and splits skewed ones
# at runtime, so the same setting holds from sf0.01 up to cluster scale.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files go with the last reference to their DataFrame
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}
# Only meaningful when this process starts the JVM (local runs, tests, bench).
LOCAL_CONF = {"spark.driver.memory": "16g"}


def get_session(master: str | None = None, app: str = "shelfwise",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        conf.update(LOCAL_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (a shared
    file system every executor can reach).  Only a local session that leaves it
    unset -- tests -- gets a private folder; on a cluster a folder of this
    machine would be lost with it, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a SparkContext (Spark Connect)
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        d = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    return d


def cluster_conf(input_bytes: int, *, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 * 1024 ** 2) -> dict:
    """Settings sized from the data volume rather than a fixed count.

    * shuffle partitions: enough that each holds ~``target_partition_bytes``
      of shuffled input (the fact tables shrink by pre-aggregation, so this is
      an upper bound), and at least 2 waves of tasks over the cluster's cores;
    * file splits: ``maxPartitionBytes`` = target, so scan tasks are sized alike;
    * AQE coalesces partitions down to the advisory size and splits skewed
      ones (a partition 5x the median and above 4x advisory) at runtime.
    Example: 100 TB on 1000 executors x 8 cores -> ~400k shuffle partitions.
    """
    cores = max(1, executors * cores_per_executor)
    parts = max(2 * cores, -(-int(input_bytes) // int(target_partition_bytes)))
    adv = str(int(target_partition_bytes // 2))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(int(target_partition_bytes)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": adv,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(int(target_partition_bytes) * 4),
        # broadcast only what the runtime statistics prove small
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    }
