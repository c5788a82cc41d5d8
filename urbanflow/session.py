"""Session construction and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every urbanflow job relies on. Event time is always UTC; ANSI
# mode stays on (all parse edges use try_* functions); AQE re-plans joins,
# coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # windowed state on local disk (RocksDB) instead of the executor heap;
    # snapshots go to the checkpoint like any other state store
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "urbanflow", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with urbanflow defaults; ``conf`` wins."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def configured_root(spark: SparkSession) -> str | None:
    """``spark.checkpoint.dir`` of the session, or the context's checkpoint dir."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # a Spark Connect session has no SparkContext
        return None


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    The only place intermediate tables and streaming checkpoints go. A session
    in one JVM (``local[...]``: tests, a laptop) that names none gets a private
    temporary folder, registered as the context's checkpoint dir so that later
    calls find it again; on a cluster a missing setting is an error, since a
    folder of one machine would not be seen by the others.
    """
    root = configured_root(spark)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="urbanflow-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _own_scratch(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/urbanflow/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, never-reused path under the shared root, in the folder of this application."""
    return "/".join([_own_scratch(spark), *parts, uuid.uuid4().hex])


def clean_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch; call it once no result that reads from it is needed any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_scratch(spark))
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
