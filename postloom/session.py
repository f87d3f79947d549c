"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# UTC so that text dates mean the same everywhere; AQE so that partition counts,
# skewed joins and small join sides are decided from measured sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keyed state with timers needs this store.
    STATE_STORE: ROCKSDB,
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A single-JVM session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("postloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started within get what keyed state needs, whatever the session names: its store, and no more partitions than
    cores (but up to 8).

    A partition of keyed state is a store and a Python worker that are opened and committed with every
    micro-batch, whether it has keys or not.  A stream keeps the settings it was started with, so the session's
    own are put back at once.
    """
    partitions = min(int(spark.conf.get(PARTITIONS)), max(spark.sparkContext.defaultParallelism, 8))
    settings = {STATE_STORE: ROCKSDB, PARTITIONS: str(partitions)}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors see, under ``spark.checkpoint.dir``.

    Only a local master may go without that setting: on a cluster a folder of one machine would
    take each executor's files to its own disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='postloom-')}"
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
