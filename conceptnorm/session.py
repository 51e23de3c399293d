"""Session helpers: runtime configuration and the shared scratch folder.

Lineage is cut with reliable ``checkpoint()`` into ``spark.checkpoint.dir``
(a shared folder on a cluster). The folder is only chosen here when the
session has none, which is the case for local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every job in the package relies on.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a join partition is split when it is 4x the median and over 64 MB
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    # compressed: a task that sorts or joins holds four to six times as much
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # broadcast decided on measured shuffle sizes at runtime
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    # a query's shuffle files go when it ends, not when the driver happens to collect garbage: what an
    # ingest exchanged would lie beside the store it wrote. A frame that runs again exchanges again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# staged and stored tables are written once and read several times
PARQUET_CODEC = "zstd"

_LOCAL_ROOT: dict[str, str] = {}


def _local_checkpoint_root(master: str) -> str:
    """A temporary folder, where one machine is all there is."""
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    base = os.environ.get("TMPDIR", "/tmp")
    if "root" not in _LOCAL_ROOT:
        _LOCAL_ROOT["root"] = tempfile.mkdtemp(prefix="conceptnorm-ckpt-", dir=base)
    return _LOCAL_ROOT["root"]


def jvm_context(spark: SparkSession):
    try:                      # classic sessions; a Connect session has none
        return spark.sparkContext
    except Exception:         # noqa: BLE001
        return None


def configure(spark: SparkSession) -> SparkSession:
    """Settings the session leaves open, and a checkpoint folder if it has
    none. What the user has set stays as it is."""
    own = spark.conf.getAll
    for key, value in RUNTIME_CONF.items():
        if key not in own and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    sc = jvm_context(spark)
    if sc is not None and sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(configured or _local_checkpoint_root(sc.master))
    return spark


def session_key(spark: SparkSession) -> str:
    """Identifies the running application (cache key for built stores)."""
    sc = jvm_context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "connect")


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "conceptnorm") -> SparkSession:
    """Session for tests, tools and the benchmark (local by default)."""
    builder = SparkSession.builder.appName(app_name)
    if master or not os.environ.get("SPARK_MASTER"):
        builder = builder.master(master or "local[8]")
    spark = (builder
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
             .config("spark.ui.enabled", "false")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             # local runs: small data, so smaller splits and coalesced
             # partitions keep every core busy (cluster defaults otherwise)
             .config("spark.sql.files.maxPartitionBytes", "8m")
             .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for staged data: the session's checkpoint folder
    (``spark.checkpoint.dir``); on a local master without one, a temporary one."""
    configure(spark)
    sc = jvm_context(spark)
    if sc is not None:
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local
    on a cluster: the checkpoint folder is the cluster's shared store)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/scratch/{name}-{uuid.uuid4().hex}"


def drop_paths(spark: SparkSession, paths: list[str]) -> int:
    """Delete staged folders through the Hadoop file system of each path
    (local, HDFS or object store alike). Returns how many were deleted; a
    session without a JVM context deletes nothing."""
    sc = jvm_context(spark)
    if sc is None:
        return 0
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    deleted = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        deleted += bool(path.getFileSystem(conf).delete(path, True))
    return deleted
