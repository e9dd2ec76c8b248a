"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the engine is designed for.  None depends on data size: AQE sizes reduce partitions,
# splits skewed ones and picks broadcast joins from the sizes it measures.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# A stateful query keeps its partition count for the life of its checkpoint, so choose it before
# the first start.  RocksDB keeps state off the heap and uploads only changes.
STREAMING_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the rows of a store costs a lookup per write; only a metric would show the count.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # Rows of a session are merged in each task before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # One store per partition of a stream-stream join instead of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # A task whose rows go to no more folders than this writes them as they come, without a sort.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

# For a query that is started anew for every drop.  A start from changelogs runs through every write
# since the last snapshot, which a short run does not upload; a start from files copies them.
RESTART_CONF = {"spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false"}

# For a query of short micro-batches whose state is the windows still open.  A lookup on the heap costs
# a fraction of a call into RocksDB; the state is the keys of an hour or two, spread over all executors.
OPEN_WINDOWS_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
}


# Shuffle data one reduce task should hold.
PARTITION_BYTES = 128 << 20


def sized_conf(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Batch settings for a job that shuffles about ``shuffle_bytes`` on ``cores`` cores.

    Shuffles start with enough partitions for the largest one; AQE merges them where less arrives.
    """
    partitions = max(2 * cores, -(-shuffle_bytes // PARTITION_BYTES))
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(2 * PARTITION_BYTES),
    }


def build_session(app_name: str = "zonepulse", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create or reuse a session; ``master`` stays unset on a cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session time zone; feeds without a zone are read as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def streaming_session(spark: SparkSession, state_partitions: int | None = None,
                      conf: dict[str, str] | None = None) -> SparkSession:
    """A sibling session with state settings, so the caller's session stays untouched.

    ``state_partitions`` defaults to the cores of the cluster.
    """
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.session.timeZone", "UTC")
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    sibling.conf.set("spark.sql.shuffle.partitions", str(partitions))
    for key, value in {**STREAMING_CONF, **(conf or {})}.items():
        sibling.conf.set(key, value)
    return sibling


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the cluster.

    Only where that is unset (local tests) a folder of our own is made and remembered.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="zonepulse-")
        sc.setCheckpointDir(configured)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique path below the shared folder (not created yet)."""
    return f"{shared_dir(spark).rstrip('/')}/zonepulse/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute a reused intermediate once and cut its lineage with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
