"""Catalog names for the lake's folders (namespaces, external tables).

The data lives in folders (see ``lake.Lake``); these helpers make it reachable
as ``silver.tlc_<service>`` and ``gold.viajes_por_zona_hora`` in the session
catalog. A namespace name is used literally, never prefixed. Dropping a table
only forgets the name: the tables are external and their files stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.lake import CANARY_NAME, MART_NAME, NAMED_MART, Lake


def _q(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(namespace)}{place}")


def register(spark: SparkSession, name: str, path: str, partitioned: bool = True) -> None:
    """Create the external table if missing and pick up partitions written since."""
    ensure_namespace(spark, name.split(".")[0])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_q(name)} USING parquet LOCATION '{path}'")
    if partitioned:
        spark.sql(f"ALTER TABLE {_q(name)} RECOVER PARTITIONS")
    spark.sql(f"REFRESH TABLE {_q(name)}")


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def partitions(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {_q(name)}")


def drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_q(name)}")


def drop_namespace(spark: SparkSession, namespace: str) -> None:
    """Drop an empty namespace if it exists (tables must be dropped first)."""
    spark.sql(f"DROP DATABASE IF EXISTS {_q(namespace)}")


def namespaces(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def register_lake(spark: SparkSession, lake: Lake, service: str = "yellow") -> list[str]:
    """Register whichever layers of the lake exist; returns the registered names."""
    from tripmart.lake import table_exists

    candidates = [
        (f"silver.tlc_{service}", lake.silver(service), True),
        (f"gold.{MART_NAME}", lake.gold(), True),
        (f"gold.{NAMED_MART}", lake.gold(NAMED_MART), True),
        (f"gold.{CANARY_NAME}", lake.gold(CANARY_NAME), False),
    ]
    done = []
    for name, path, partitioned in candidates:
        if table_exists(spark, path):
            register(spark, name, path, partitioned)
            done.append(name)
    return done
