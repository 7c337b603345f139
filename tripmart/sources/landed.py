"""What actually arrived in a landing folder: one row per file with its byte length."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators import landing, ledgers


def landed_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(key, length, modified) for every file below ``root``.

    The ``binaryFile`` source prunes the content column when it is not
    selected, so only the listing is read, never the bytes. ``key`` is the
    path relative to ``root``.
    """
    prefix = root.rstrip("/") + "/"
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "modificationTime")
    )
    return files.select(
        # \Q...\E quotes the root literally inside the (Java) pattern.
        F.regexp_replace(F.col("path"), "^.*?\\Q" + prefix.split("://")[-1] + "\\E", "").alias("key"),
        F.col("length"),
        F.col("modificationTime").alias("modified"),
    )


def changed_files(spark: SparkSession, files: DataFrame, snapshots: str) -> DataFrame:
    """Which of ``files`` (key, length, modified) are new, changed or gone since the last call.

    The difference is kept as a change set below ``snapshots`` and returned from there, so
    it is what later calls compare with; unchanged objects are neither written nor returned.
    """
    before = ledgers.state(spark, snapshots, landing.LISTING_SCHEMA)
    number = ledgers.append(spark, landing.listing_changes(files, before), snapshots)
    return ledgers.changes_of(spark, snapshots, number)
