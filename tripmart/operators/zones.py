"""Zone names on trips and marts, and the consistency of the zone catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ZONE_ID = "LocationID"


def with_zone_names(df: DataFrame, zones: DataFrame, id_col: str = "pu_location_id") -> DataFrame:
    """Left join of zone names; unmatched ids keep their rows with null names.

    Ids such as "Unknown" or "Outside of NYC" are rows of the catalogue, so they
    come out as data, never as nulls. The planner broadcasts the catalogue from its
    byte size, or joins by shuffle beyond the threshold.
    """
    dim = zones.select(
        F.col(ZONE_ID).alias("_zone_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zona_nombre"),
        F.col("service_zone").alias("service_zone"),
    )
    joined = df.join(dim, F.col(id_col) == F.col("_zone_id"), "left")
    return joined.drop("_zone_id")


def id_gaps(zones: DataFrame) -> DataFrame:
    """Ids missing from 1..max(id).

    The expected ids come from ``spark.range``, generated across tasks, so even a
    catalogue with a stray huge id never expands inside one task.
    """
    top = zones.agg(F.max(ZONE_ID)).first()[0]
    if top is None or top < 1:
        return zones.sparkSession.createDataFrame([], f"{ZONE_ID} int")
    expected = zones.sparkSession.range(1, int(top) + 1).select(F.col("id").cast("int").alias(ZONE_ID))
    return expected.join(zones.select(ZONE_ID), ZONE_ID, "left_anti")


def id_duplicates(zones: DataFrame) -> DataFrame:
    """Ids present more than once."""
    return zones.groupBy(ZONE_ID).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def unknown_zones(trips: DataFrame, zones: DataFrame, id_col: str = "pu_location_id") -> DataFrame:
    """Zone ids used by trips but absent from the catalogue, with trip counts.

    Trips are pre-aggregated per zone id before the anti join, so the join works
    on one row per id whatever the number of trips.
    """
    per_zone = trips.groupBy(F.col(id_col).alias(ZONE_ID)).agg(F.count(F.lit(1)).alias("viajes"))
    return per_zone.join(zones.select(ZONE_ID), ZONE_ID, "left_anti")


def catalogue_problems(trips: DataFrame, zones: DataFrame, id_col: str = "pu_location_id") -> DataFrame:
    """D9 + J3 as one violation list: (problema, location_id, n)."""
    gaps = id_gaps(zones).select(F.lit("hueco").alias("problema"), ZONE_ID, F.lit(0).cast("bigint").alias("n"))
    dups = id_duplicates(zones).select(F.lit("duplicado").alias("problema"), ZONE_ID, "n")
    unknown = unknown_zones(trips, zones, id_col).select(
        F.lit("sin_zona").alias("problema"), ZONE_ID, F.col("viajes").alias("n")
    )
    return gaps.unionByName(dups).unionByName(unknown).withColumnRenamed(ZONE_ID, "location_id")


def special_zone_trips(mart: DataFrame, zones: DataFrame) -> DataFrame:
    """Clean trips in the catalogue's "Unknown" and "Outside of NYC" zones."""
    special = zones.where((F.col("Borough") == "Unknown") | (F.col("Zone") == "Outside of NYC")).select(
        F.col(ZONE_ID).alias("pu_location_id")
    )
    return (
        mart.join(special, "pu_location_id", "left_semi")
        .groupBy("pu_location_id")
        .agg(F.sum("viajes").alias("viajes"))
    )
