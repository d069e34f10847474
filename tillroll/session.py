"""Session settings the pipeline relies on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Week boundaries, timestamp parsing and date labels are defined in UTC.  Spark
# resolves the zone into an expression when a DataFrame is built, so it is enough
# to pin it while a job or query is put together (see ``pinned``).
PINNED_CONF = {"spark.sql.session.timeZone": "UTC"}

# Held while files are written below one folder per source file: a task keeps this many
# open at once and writes rows as they come; without it, it would sort them all first.
OPEN_FILES_CONF = {"spark.sql.maxConcurrentOutputFileWriters": "32"}

# Held while bronze, silver and the per-file totals are written.  A line takes some 20
# bytes in these files: a task of 128 MB would hold millions of lines, and their partial
# sums more than its memory.  A timestamp is a long, not the 12 bytes of INT96.
LAYER_CONF = {
    **OPEN_FILES_CONF,
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Settings of the sessions that tests and the bench start themselves.
LOCAL_CONF = {
    **PINNED_CONF,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Partitioned writes use REBALANCE; let AQE split hot partitions.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # No broadcast from static size estimates: a join side is broadcast only
    # when AQE has measured its shuffle output (or after an explicit size
    # check, see operators.joins).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


@contextmanager
def pinned(spark: SparkSession, conf: dict[str, str] = PINNED_CONF) -> Iterator[SparkSession]:
    """Hold ``conf`` inside the block; the caller's settings come back after it."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        if before[key] != value:
            spark.conf.set(key, value)
    try:
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            elif value != conf[key]:
                spark.conf.set(key, value)


def local_session(app: str = "tillroll", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a folder every executor can reach).  Only a
    local-mode session without it gets a fresh folder of its own, as in tests.
    """
    root = spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None) or None
        if root:
            spark.sparkContext.setCheckpointDir(root)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at a folder shared by "
                "the driver and all executors"
            )
        root = tempfile.mkdtemp(prefix="tillroll-checkpoint-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder under the shared root (never reused, never cleared)."""
    return f"{shared_root(spark)}/tillroll/{label}-{uuid.uuid4().hex}"
