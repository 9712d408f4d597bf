"""Folders and sessions for streams."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from floorline.session import pin_clock

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the cluster's ``spark.checkpoint.dir``.

    Checkpoints and tables written between jobs must outlive any one machine.
    Only a local session without that setting gets a temporary folder.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="floorline-")
    return f"{base.rstrip('/')}/floorline/{purpose}-{uuid.uuid4().hex}"


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session for stateful streams, separate from the caller's settings.

    The number of state partitions is fixed for the life of a checkpoint and
    adaptive execution does not change it, so it is set here: one per core
    unless given.  State is kept in RocksDB, on disk beside the executor with
    its changes in the checkpoint, so it may exceed memory and survives the
    loss of the executor.
    """
    session = pin_clock(spark.newSession())
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    for key, value in {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }.items():
        session.conf.set(key, value)
    return session
