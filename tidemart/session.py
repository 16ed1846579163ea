"""Session settings, the shared working folder, and sessions for stateful streams."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every plan in this package is written for.
BATCH_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even when a later step wants the join's partitioning;
    # the extra exchange is cheaper than one task holding a third of the rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task that splits amounts sorts and hashes its rows several times, 1.6 KB a row.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}
# Input that a shuffle partition stands for: a task's memory does not grow with the tables.
PARTITION_BYTES = 4 * 1024 * 1024
# Rows that pass between Spark and Python at once; by number of rows alone, 10,000 texts and
# their pieces are some 100 MB on both sides.
BATCH_BYTES = 4 * 1024 * 1024

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting rows costs a lookup per write and only feeds a progress number.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
# For jobs that take a backlog in a few large micro-batches: what such a batch has shuffled
# goes when it ends, not when the driver happens to collect its garbage. Its state is kept as
# one snapshot, of the last two batches, and is not held open on the executors besides.
BACKLOG_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    "spark.sql.streaming.stateStore.rocksdb.compactOnCommit": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}
# Input that a state partition of such a job stands for: a task sorts its rows in memory.
STATE_BYTES = 64 * 1024 * 1024


def build_session(app_name: str = "tidemart", cpus: str | int = "*") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Remembering the Python line of every expression only serves error messages.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )


def tune(spark: SparkSession, time_zone: str = "UTC", input_bytes: int = 0) -> SparkSession:
    """Apply the runtime settings to a session that somebody else created.

    Days and hours depend on the session zone, so it is always set explicitly.
    The shuffle starts from at least two partitions per core of the cluster, and one per
    `PARTITION_BYTES` of input, and AQE merges the small ones, so the same code fits eight
    cores and thousands.
    """
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    floor = 2 * spark.sparkContext.defaultParallelism
    spark.conf.set(
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
        str(max(configured, floor, input_bytes // PARTITION_BYTES)),
    )
    return spark


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Let a session's Arrow batches end at `BATCH_BYTES`, however long its rows are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def state_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A sibling session whose streams keep state in RocksDB.

    The number of state partitions is fixed for the life of a checkpoint, so it is
    chosen here once: one per core of the cluster unless the caller says otherwise.
    """
    sibling = tune(spark.newSession(), spark.conf.get("spark.sql.session.timeZone"))
    for key, value in STATE_SETTINGS.items():
        sibling.conf.set(key, value)
    # Rows that hold packed rows are long.
    bounded_batches(sibling)
    count = partitions or spark.sparkContext.defaultParallelism
    sibling.conf.set("spark.sql.shuffle.partitions", str(count))
    return sibling


def backlog_session(spark: SparkSession, input_bytes: int) -> SparkSession:
    """A state session for streams that take `input_bytes` in a few large micro-batches, with
    at least one state partition per `STATE_BYTES`."""
    partitions = max(spark.sparkContext.defaultParallelism, input_bytes // STATE_BYTES)
    sibling = state_session(spark, partitions)
    for key, value in BACKLOG_SETTINGS.items():
        sibling.conf.set(key, value)
    return tune(sibling, spark.conf.get("spark.sql.session.timeZone"), input_bytes)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Every executor must see it, so a machine-local folder is only accepted when
    the whole application runs on one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidemart-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
