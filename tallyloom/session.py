"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
PARTITIONS_KEY = "spark.sql.shuffle.partitions"
INITIAL_KEY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
BROADCAST_TIMEOUT_KEY = "spark.sql.broadcastTimeout"
#: Stored bytes of all tables of a job per shuffle partition, so that the sort of one fits a task's memory.
PARTITION_BYTES = 64 << 20

# Scratch paths handed out, by Spark application.
_GIVEN: dict[str, list[str]] = {}

RUNTIME_SETTINGS = {
    # Dates and hours are UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    # A bad cast fails the job instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Sessions of one hot user are merged inside each map task before the shuffle.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    # Streaming state lives in RocksDB, off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every job here relies on to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if context.master.startswith("local") and not context.getConf().contains(PARTITIONS_KEY):
        # One machine: a partition per core. A cluster's own setting is never touched.
        spark.conf.set(PARTITIONS_KEY, str(context.defaultParallelism))
    return spark


@contextmanager
def sized_for(spark: SparkSession, path: str) -> Iterator[None]:
    """Shuffle partitions by the size of the tables below ``path``, for one job.

    Spark starts with that many and joins small ones. Never fewer than the session has, and a session
    that sets the number to start with keeps it. A broadcast may wait for the other jobs' tasks.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    size = files.getContentSummary(place).getLength() if files.exists(place) else 0
    own = {key: spark.conf.get(key, None) for key in (INITIAL_KEY, BROADCAST_TIMEOUT_KEY)}
    if own[INITIAL_KEY] is None:
        spark.conf.set(INITIAL_KEY, str(max(int(spark.conf.get(PARTITIONS_KEY)), size // PARTITION_BYTES)))
    spark.conf.set(BROADCAST_TIMEOUT_KEY, "-1")
    try:
        yield
    finally:
        for key, value in own.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def local_session(cores: str = "*", partitions: int = 8, app: str = "tallyloom") -> SparkSession:
    """A session for tests and the bench; on a cluster, submit and call ``configure``."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config(PARTITIONS_KEY, str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the folder all executors share.

    The folder is the one the session names in ``spark.checkpoint.dir``. Only a
    local-mode session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tallyloom-")
    path = f"{root.rstrip('/')}/tallyloom/{label}-{uuid.uuid4().hex}"
    _GIVEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables that this application has made, and say how many there were.

    Frames and streams of earlier queries may still read theirs, so call it when their results
    have been written or shown. Scratch of other applications stays.
    """
    removed = 0
    for path in _GIVEN.pop(spark.sparkContext.applicationId, []):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        removed += files.delete(place, True)  # False where nothing was written
    return removed
