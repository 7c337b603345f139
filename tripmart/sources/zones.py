"""The zone catalogue: a CSV with every header quoted, four text-or-id columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ZONE_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """S3: read with an explicit schema (no inference); ``N/A`` stays text.

    FAILFAST: a malformed catalogue is an error, not rows with nulls.
    """
    return spark.read.csv(path, header=True, schema=ZONE_SCHEMA, mode="FAILFAST", enforceSchema=False)


def write_zones(zones: DataFrame, path: str) -> str:
    """Land a zone catalogue as a folder of quoted CSV files, as its tasks give them."""
    zones.write.mode("overwrite").csv(path, header=True, quoteAll=True)
    return path
