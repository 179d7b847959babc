"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
HEAP_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
DISK_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Adaptive execution picks join sides and partition counts from real sizes and splits skewed joins.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Stream state lives on local disk with checkpoints in the shared folder, not in the heap.
    STATE_STORE: DISK_STORE,
    # Sessions of one trip are merged before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.ui.enabled": "false",
    # Looking up the caller's line for every column function takes most of the time of building a long plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


MB = 1024 * 1024
MOST_SHUFFLE_PARTITIONS = 50_000
MOST_SCAN_TASKS = 200_000


def sized_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Partition settings for an input size.

    Shuffle partitions start at about 128 MB and adaptive execution merges the small ones. Beyond a few
    terabytes partitions grow instead of multiplying, since shuffle blocks are map tasks times shuffle
    partitions: 100 TB gives 50,000 partitions of about 2 GB, sorted with spilling.
    """
    partitions = min(max(cores, -(-input_bytes // (128 * MB))), max(cores, MOST_SHUFFLE_PARTITIONS))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
        "spark.sql.files.maxPartitionBytes": str(max(256 * MB, -(-input_bytes // MOST_SCAN_TASKS))),
    }


def build_session(app: str = "odolytics", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    # Python workers import this package; on a cluster install it there or ship it with --py-files.
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = os.pathsep.join(p for p in (root, os.environ.get("PYTHONPATH")) if p)
    for key, value in {**DEFAULTS, "spark.executorEnv.PYTHONPATH": paths, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local session without one gets its own."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="odolytics-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for a table a job writes."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


PARTS = "spark.sql.shuffle.partitions"
STATE_PARTS_PER_CORE = 4


def state_parts(spark: SparkSession) -> int:
    """Partitions of a stream's state: every trigger loads, commits and uploads each of them, rows or not, so a few per core
    and at most the session's."""
    return min(int(spark.conf.get(PARTS)), STATE_PARTS_PER_CORE * spark.sparkContext.defaultParallelism)


_starting = threading.Lock()


@contextmanager
def state_on_disk(spark: SparkSession, parts: int | None = None) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, also in a session made without ``DEFAULTS``; in ``parts``
    partitions, if given.

    Spark's own default keeps state in the heap and cannot run ``transformWithState``. A query takes its settings when it
    starts, so the session's are put back; another store that the session names stays. A stream that goes on keeps the
    partitions it began with.
    """
    with _starting:
        before = {STATE_STORE: spark.conf.get(STATE_STORE, HEAP_STORE), PARTS: spark.conf.get(PARTS)}
        wanted = {STATE_STORE: DISK_STORE} if before[STATE_STORE] == HEAP_STORE else {}
        if parts:
            wanted[PARTS] = str(parts)
        for name, value in wanted.items():
            spark.conf.set(name, value)
        try:
            yield
        finally:
            for name in wanted:
                spark.conf.set(name, before[name])
