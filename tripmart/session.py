"""Session helpers.

The library never builds its own cluster settings behind the user's back; it only
pins what the semantics depend on (wall-clock timestamps are read in UTC) and finds
a shared folder for written intermediate tables.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the results depend on. `timestampdiff` and `date_format` on
# timestamp_ntz go through the session zone, so the zone is pinned.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Pinned beside them for speed; no result depends on it. HotSpot never compiles a method of more
# than 8,000 bytes, and a filter on flags that are computed in the same plan repeats their
# expressions into one such method, which is then interpreted row by row. Above this size Spark
# generates its operators one by one, in small methods.
SPEED_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# Recommended settings for a large cluster (pass with --conf to spark-submit).
# Silver tasks each read and write one slice of one month; the only data-sized
# shuffle is the REBALANCE of landing writes, governed by the advisory size.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "2000",
    "spark.sql.sources.partitionOverwriteMode": "static",  # dynamic is set per write
    "spark.speculation": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings the semantics rely on; leave everything else alone.

    This changes the session given: its time zone becomes UTC, for plans built before
    as well. Queries call it when they are built; keep the settings until they have run.
    """
    for key, value in (REQUIRED_CONF | SPEED_CONF).items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(
    cores: int | str = "*",
    app: str = "tripmart",
    shuffle_partitions: int = 8,
    event_log_dir: str | None = None,
    advisory_partition_size: str | None = None,
) -> SparkSession:
    """A local session for tests and the benchmark (never used on a cluster).

    ``event_log_dir`` turns on Spark's event log there, for stage and task times.
    ``advisory_partition_size`` sizes adaptive partitions to the data at hand.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TRIPMART_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    if advisory_partition_size:
        builder = builder.config("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory_partition_size)
    if event_log_dir:
        os.makedirs(event_log_dir, exist_ok=True)
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


# Months that a task writes side by side; it sorts the rows of any further ones.
OPEN_MONTHS = 128
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def months_side_by_side(spark: SparkSession) -> Iterator[None]:
    """Writes by month within it keep a file open for each month of a task.

    Otherwise Spark sorts all rows of a task by month first, which takes about 300 bytes of memory
    for a row of silver; a split of 128 MB may hold many millions of rows. An open file holds its
    rows encoded, up to one row group.
    """
    before = spark.conf.get(_WRITERS, None)
    spark.conf.set(_WRITERS, str(OPEN_MONTHS))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_WRITERS)
        else:
            spark.conf.set(_WRITERS, before)


# Most partitions of a shuffle that Spark writes row by row (its bypassMergeThreshold).
MONTH_PARTITIONS = 200


def month_partitions(spark: SparkSession) -> int:
    """Partitions of a shuffle that deals rows out by month: the session's number, up to 200.

    With more, a task keeps the rows of its split, about 210 bytes each, to sort them by partition.
    Few tables have more months, and a month that is large for one task is split by
    adaptive execution whatever the number.
    """
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), MONTH_PARTITIONS)


class NoSharedFolder(RuntimeError):
    """A cluster session that names no folder all executors can reach."""


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster it must be set to storage that every executor can reach; without it
    this raises before anything is written. Only a local master, where driver and
    executors are one process, gets a folder of its own (as in tests).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    try:
        context = spark.sparkContext
    except Exception as err:  # noqa: BLE001 - sessions without a local context (Spark Connect)
        raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors share") from err
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not _single_process(context.master):
        raise NoSharedFolder(f"set spark.checkpoint.dir to a folder that all executors of {context.master} share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tripmart-ckpt-"))
    return context.getCheckpointDir().rstrip("/")


def _single_process(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh, uniquely named folder below the shared directory."""
    return f"{shared_dir(spark)}/tripmart/{name}-{uuid.uuid4().hex[:12]}"
