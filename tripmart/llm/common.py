"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.session import shared_dir

#: Filter tables have this many places, whatever the size of the input.
PLACES = 1 << 22

PACKAGE_HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def reach(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver did.

    Only adds its folder to their search path; a cluster without that folder needs
    the package installed or shipped with the job, as for any PySpark library.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_HOME not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_HOME, *paths])
    return spark


#: What Python workers are told about memory: freed arrays and Arrow buffers go back to the system.
LEAN = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": "262144", "MALLOC_TRIM_THRESHOLD_": "262144"}
#: Bytes of an Arrow batch on its way to a Python worker.
BATCH_BYTES = "4m"


def lean(spark: SparkSession) -> SparkSession:
    """``reach``, for jobs of many stages in one session: batches are bounded by bytes, since rows
    may be long, and workers that serve one stage after the other do not keep what they freed."""
    reach(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.sparkContext.environment.update(LEAN)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared checkpoint folder.

    A reliable checkpoint: the rows survive lost executors and later plans start
    from them instead of from the whole lineage.
    """
    shared_dir(df.sparkSession)  # a folder of our own only where none is configured
    return df.checkpoint(eager=True)


def positions(df: DataFrame, *order) -> DataFrame:
    """``df`` with its 0-based place in ``order`` as ``position``, kept in the shared folder.

    A range sort over all partitions, then each partition's start: no task sorts or
    counts all rows.
    """
    at = held(
        df.orderBy(*order)
        .withColumn("__at", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftrightunsigned("__at", 33))
        .withColumn("__off", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    # one row for each partition of the sort
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = at.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")).select(
        F.col("__part").alias("__of"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    return (
        at.join(F.broadcast(starts), F.col("__part") == F.col("__of"))
        .withColumn("position", F.col("__start") + F.col("__off"))
        .drop("__at", "__part", "__off", "__of", "__start", "__n")
    )


def utf8(column: pa.Array) -> Iterator[bytes | None]:
    """The values of a string column as bytes, one at a time (null stays None)."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for value in column.cast(kind):
        yield value.as_py()


def batches(rows: Iterator[tuple], schema: pa.Schema, most_rows: int = 8192, most_bytes: int = 16 << 20):
    """Arrow batches of at most ``most_rows`` rows and about ``most_bytes`` of strings and bytes."""
    held_rows: list[tuple] = []
    size = 0
    for row in rows:
        held_rows.append(row)
        size += sum(len(x) for x in row if isinstance(x, (bytes, str)))
        if len(held_rows) >= most_rows or size >= most_bytes:
            yield _batch(held_rows, schema)
            held_rows, size = [], 0
    if held_rows:
        yield _batch(held_rows, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def place(key: int) -> int:
    """The place of a long in a filter table, as Spark's xxhash64 gives it."""
    value = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), seed=42)
    return value % PLACES  # PLACES divides 2^64, so the sign does not matter


def places(keys: DataFrame, column: str) -> np.ndarray:
    """A table of PLACES booleans: True where some key (long) falls.

    Its size is fixed; keys that share a place only let more rows through.
    """
    found = keys.select(F.pmod(F.xxhash64(column), F.lit(PLACES)).cast("int").alias("p")).distinct().toArrow()
    table = np.zeros(PLACES, bool)
    table[found.column("p").to_numpy()] = True
    return table


def in_places(df: DataFrame, column: str, table: np.ndarray) -> DataFrame:
    """The rows of ``df`` whose ``column`` falls on a marked place (and some others)."""
    known = df.sparkSession.sparkContext.broadcast(np.packbits(table))  # PLACES / 8 bytes

    def run(batches_in):
        marked = np.unpackbits(known.value).astype(bool)
        for batch in batches_in:
            yield batch.filter(pa.array(marked[batch.column("__place").to_numpy()]))

    placed = df.withColumn("__place", F.pmod(F.xxhash64(column), F.lit(PLACES)).cast("int"))
    return placed.mapInArrow(run, placed.schema).drop("__place")
