"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # recording a call site per column costs more than planning these wide rows
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # keyed state that outgrows executor memory lives in RocksDB
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # how soon the state of ended queries and of batches that no restart reads leaves the disk
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
}


def build_session(master: str | None = None, app: str = "tidemart", **conf) -> SparkSession:
    """Session with the warehouse settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def use_settings(spark: SparkSession) -> SparkSession:
    """Apply the warehouse settings to a session somebody else made.

    On a local master the default shuffle partitions become one per core, as
    stateful streams open a store for each.
    """
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    context = spark.sparkContext
    if context.master.startswith("local") and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(context.defaultParallelism))
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int, per_task: int = 128 << 20) -> int:
    """Shuffle partitions for an input, one per ``per_task`` bytes and at least one per core.

    Adaptive execution merges small partitions but splits only skewed ones, so
    start high enough. A stateful stream keeps the number of its first start.
    """
    partitions = max(-(-input_bytes // per_task), spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names the parent in ``spark.checkpoint.dir``. Only a local
    master may fall back to this machine's temporary folder.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if not parent:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        parent = tempfile.mkdtemp(prefix="tidemart-")
    return f"{parent.rstrip('/')}/{name}-{uuid.uuid4().hex}"
