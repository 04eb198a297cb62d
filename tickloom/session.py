"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHECKPOINT_DIR = "spark.checkpoint.dir"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# Recommended when the session is built.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Recording a Python call site for every column makes building large plans slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    STATE_STORE: ROCKSDB,
}

_shipped: set[str] = set()


def builder(app: str = "tickloom") -> SparkSession.Builder:
    """A session builder with the recommended settings."""
    b = SparkSession.builder.appName(app)
    for k, v in SETTINGS.items():
        b = b.config(k, v)
    return b


def configure(spark: SparkSession) -> SparkSession:
    """Set what results depend on, in a session built elsewhere, and ship the package.

    All event times are UTC, whatever zone the machines are in, and per-ticker streaming
    state needs the RocksDB store.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set(STATE_STORE, ROCKSDB)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Workers unpickle library functions by name, so they must be able to import the
    package wherever they run.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tickloom-"), "tickloom_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


@contextmanager
def fine_shuffles(spark: SparkSession, partitions: int = 1000) -> Iterator[None]:
    """Batch jobs in here shuffle to at least so many partitions, which adaptive execution
    merges up to its advisory size: a task's share stays the same as the input grows."""
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    usual = before or spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(INITIAL_PARTITIONS, max(int(usual), partitions))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's checkpoint folder.

    Only a ``local`` master may leave ``spark.checkpoint.dir`` unset; a temporary folder
    is then made and kept for the whole session. On a cluster such a folder would be
    another one on each machine.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all machines of {master} share")
        base = tempfile.mkdtemp(prefix="tickloom-")
        spark.conf.set(CHECKPOINT_DIR, base)
    return f"{base.rstrip('/')}/tickloom/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared folder and read back, so that its
    lineage ends there and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder; for small shared results."""
    return stored(df, "checkpoint")
