"""Gold: the mart of clean trips by month, pickup zone and hour.

Gold drops exactly what silver marked and adds no rule of its own. The grain
includes the month so that a second month never adds onto the first.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.flags import FLAG_NAMES, MONTH, duration_seconds, is_clean
from tripmart.lake import CANARY_NAME, NAMED_MART, Lake, drop_months, month_folders, read_months, table_exists
from tripmart.operators.zones import with_zone_names

# Rows of a row group of the mart, about twenty zones of a month, and the writer's option for it.
ROW_GROUP_ROWS, ROW_GROUP_OPTION = 512, "parquet.block.row.count.limit"

GRAIN = (MONTH, "pu_location_id", "hora")
MART_COLUMNS = (*GRAIN, "viajes", "ingreso", "distancia_total", "duracion_media_seg")


class EmptyMart(RuntimeError):
    """A month to refresh is not in silver."""


def clean(silver: DataFrame, flags: Sequence[str] = FLAG_NAMES) -> DataFrame:
    """Silver rows that carry no flag. Flags are stored, so the filter is pushed down."""
    return silver.where(is_clean(flags))


def mart(silver: DataFrame) -> DataFrame:
    """Aggregate clean silver rows by (month, pickup zone, pickup hour)."""
    return aggregate(clean(silver))


def aggregate(rows: DataFrame) -> DataFrame:
    """The mart's aggregate over rows already known to be clean.

    Partial aggregation runs before the shuffle, so even a zone/hour holding a
    third of all trips is combined inside each task; the exchange carries at most
    one row per group per task.
    """
    return (
        rows.groupBy(F.col(MONTH), F.col("pu_location_id"), F.hour("pickup_datetime").alias("hora"))
        .agg(
            F.count(F.lit(1)).alias("viajes"),
            # decimal(10,2) summed stays exact: decimal(20,2)
            F.sum("total_amount").alias("ingreso"),
            F.sum("trip_distance").alias("distancia_total"),
            F.avg(duration_seconds()).alias("duracion_media_seg"),
        )
    )


def _write(m: DataFrame, path: str, dynamic: bool) -> None:
    # The aggregate is bounded by months x zones x hours; one task per month is
    # small by construction, and keeps one file per month partition. A file is sorted by
    # the grain and cut into small row groups, so a filter by zone skips nearly all of them.
    clustered = m.repartition(F.col(MONTH)).sortWithinPartitions(*GRAIN)
    writer = clustered.write.mode("overwrite").partitionBy(MONTH).option(ROW_GROUP_OPTION, ROW_GROUP_ROWS)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def build(spark: SparkSession, lake: Lake, service: str = "yellow", target: str | None = None) -> str:
    """Rebuild the whole mart from silver, partitioned by month."""
    target = target or lake.gold()
    source = spark.read.parquet(lake.silver(service))
    write_mart(mart(source), target)
    return target


def write_mart(rows: DataFrame, path: str) -> None:
    """Write a whole mart, partitioned by month."""
    _write(rows, path, dynamic=False)


def refresh(
    spark: SparkSession,
    lake: Lake,
    months: Sequence[str],
    service: str = "yellow",
    target: str | None = None,
) -> str:
    """Recompute only the given months from silver, so that the mart equals a rebuild.

    Silver is read with partition pruning on the months. Months with clean trips
    replace their partitions; a month without any (all its rows are flagged) loses
    its partition, as a rebuild would leave it out.
    """
    target = target or lake.gold()
    wanted = list(months)
    in_silver = month_folders(spark, lake.silver(service))
    if in_silver is None:
        return build(spark, lake, service, target)  # no listing: a full rebuild is the same mart
    absent = sorted(set(wanted) - set(in_silver))
    if absent:
        raise EmptyMart(f"months not in silver: {', '.join(absent)}")
    fresh = mart(read_months(spark, lake.silver(service), wanted))
    replace_months(spark, fresh, target, wanted)
    return target


def replace_months(spark: SparkSession, fresh: DataFrame, target: str, months: Sequence[str]) -> None:
    """Put the rows of ``fresh`` in place of the given months of the mart at ``target``."""
    seen = Observation(f"mart_{uuid.uuid4().hex}")
    filled = fresh.observe(seen, F.collect_set(MONTH).alias("months"))  # at most the months given
    _write(filled, target, dynamic=table_exists(spark, target))
    emptied = set(months) - set(seen.get["months"])
    drop_months(spark, target, sorted(emptied & set(month_folders(spark, target) or ())))


def build_with_names(spark: SparkSession, lake: Lake, zones: DataFrame) -> str:
    """The mart with pickup-zone names, rebuilt from the written mart.

    The planner broadcasts the zone catalogue from its byte size; unmatched ids keep
    their rows with null names, and the zones that are data ("Unknown",
    "Outside of NYC") come out as names, never as nulls.
    """
    target = lake.gold(NAMED_MART)
    named = with_zone_names(spark.read.parquet(lake.gold()), zones)
    _write(named, target, dynamic=False)
    return target


def canary(silver: DataFrame) -> DataFrame:
    """One row, one column: how many rows silver holds."""
    return silver.agg(F.count(F.lit(1)).alias("filas_en_silver"))


def write_canary(spark: SparkSession, lake: Lake, service: str = "yellow") -> str:
    target = lake.gold(CANARY_NAME)
    canary(spark.read.parquet(lake.silver(service))).write.mode("overwrite").parquet(target)
    return target
