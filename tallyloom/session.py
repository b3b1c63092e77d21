"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Semantics the operators rely on; performance settings stay with the cluster.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",  # a bad cast fails the query, it never becomes NULL
    "spark.sql.variant.allowDuplicateKeys": "true",  # last duplicate JSON key wins
}

# Runtime re-planning: broadcast is chosen from measured sizes, hot join keys are split.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # small shares of a side are hashed: the wide side of a lookup is not sorted
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
}

# What a job leaves on disk: shuffles go when their query has ended, files are packed tightly.
DISK = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

STREAM_STATE = {
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    # state on disk with bounded memory, not as objects of the executor's heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session somebody else created."""
    for key, value in {**SEMANTICS, **ADAPTIVE, **DISK, **STREAM_STATE}.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and the bench; on a cluster use spark-submit + configure()."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        # a stack trace per column expression: helps debugging, doubles the time to plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_base: list[str] = []


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder the cluster names in spark.checkpoint.dir.

    Where that setting is absent it is an error, except on a local master: there one process
    does all the work, and a folder of its own will do.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _local_base:
            _local_base.append(tempfile.mkdtemp(prefix="tallyloom-"))
        base = _local_base[0]
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
