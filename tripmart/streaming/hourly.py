"""Hourly event files: landing, counting (batch and Structured Streaming), gaps.

Events arrive as one gzip JSON folder per hour; a missing hour is normal and is
reported, not fabricated. The streaming count is an update-mode aggregate without
a watermark: a file may land at any time, and no event is ever dropped for being
late. Its state is one row per hour of the calendar (about 9,000 a year), so nothing
needs evicting. Each micro-batch writes its updated hours into a folder of a changelog,
which is compacted as the stream goes (``changelog``), and readers take the latest value
per hour. A batch is written whole or not at all and a replayed batch has the same values, so
a lost executor or a restarted query never double counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.streaming import changelog

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
HOUR_DIR = "hora"  # folder key of an hourly file: hora=YYYY-MM-DDTHH


def hour_start(ts: Column) -> Column:
    """Start of the hour of a wall-clock timestamp, kept as timestamp_ntz."""
    return F.date_trunc("HOUR", ts).cast("timestamp_ntz")


def hour_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH")


def land_hourly_files(events: DataFrame, root: str, mode: str = "overwrite") -> str:
    """Write events as gzip JSON, one folder per hour.

    ``REBALANCE`` on the hour keeps each hour's rows in few tasks (few files per
    folder); adaptive execution splits a busy hour and merges quiet ones.
    """
    (
        events.withColumn(HOUR_DIR, hour_label(F.col("ts")))
        .hint("rebalance", HOUR_DIR)
        .write.mode(mode)
        .option("compression", "gzip")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .partitionBy(HOUR_DIR)
        .json(root)
    )
    return root


def read_hourly_files(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """Batch read of landed hourly files, of one folder or several, with the fixed event schema."""
    return (
        spark.read.schema(EVENT_SCHEMA)
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .option("recursiveFileLookup", "true")
        .json(root)
    )


def hourly_counts(events: DataFrame) -> DataFrame:
    """Events per hour present in the data: (hora timestamp_ntz, eventos bigint)."""
    return events.groupBy(hour_start(F.col("ts")).alias("hora")).agg(F.count(F.lit(1)).alias("eventos"))


_HOUR_SECONDS = 3600


def missing_hours(events: DataFrame) -> DataFrame:
    """Hours of the covered months without any event.

    The expected range runs from the first hour of the month of the earliest event to
    the last hour of the month of the latest one. Only those two instants reach the
    driver; the hours between them come from a distributed ``range``, so a corrupt
    timestamp makes more tasks, not one huge array. Present hours are anti-joined away.
    """
    month = F.date_trunc("MONTH", F.col("ts"))
    first, last = events.agg(
        F.min(F.unix_seconds(month.cast("timestamp"))), F.max(F.unix_seconds((month + F.expr("INTERVAL 1 MONTH")).cast("timestamp")))
    ).first()
    hours = events.sparkSession.range(*(0, 0) if first is None else (first // _HOUR_SECONDS, last // _HOUR_SECONDS))
    expected = hours.select(F.timestamp_seconds(F.col("id") * _HOUR_SECONDS).cast("timestamp_ntz").alias("hora"))
    present = events.select(hour_start(F.col("ts")).alias("hora")).distinct()
    return expected.join(present, "hora", "left_anti")


def start_hourly_stream(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    state_partitions: int = 16,
    compact_every: int = changelog.COMPACT_EVERY,
):
    """Count events per hour from landed files as a Structured Streaming query.

    Every landed event counts, in whatever order its file arrives.
    ``state_partitions`` sizes the state store: after map-side partial aggregation the
    state holds one row per hour, so it stays small however large the input is. It is
    fixed in the checkpoint at the first start. The changelog in ``sink`` is compacted after
    every ``compact_every`` batches. Returns the ``StreamingQuery``.
    """
    spark = _stream_session(spark, state_partitions)
    reader = spark.readStream.schema(EVENT_SCHEMA).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    counts = hourly_counts(reader.json(source))

    def append_batch(batch: DataFrame, batch_id: int) -> None:
        changelog.write_batch(batch, sink, batch_id)
        if batch_id % compact_every == compact_every - 1:
            changelog.compact(spark, sink)

    writer = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(
        append_batch
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def _stream_session(spark: SparkSession, state_partitions: int) -> SparkSession:
    """A sibling session (same cluster, own SQL settings) whose shuffle width is
    the state width, leaving the caller's settings untouched."""
    try:
        child = spark.newSession()
    except Exception:  # noqa: BLE001 - sessions that cannot fork keep their own setting
        return spark
    child.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    # Each trigger lists the source folder; a few tasks listing many folders each
    # beat one task per hourly folder.
    child.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(max(2 * state_partitions, 32)))
    child.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return child


def read_hourly_sink(spark: SparkSession, sink: str) -> DataFrame:
    """Latest count per hour from the changelog written by the stream."""
    return changelog.latest(spark, sink)
