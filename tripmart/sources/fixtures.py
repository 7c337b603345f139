"""Trip-shaped inputs derived from the driver's tables (FIXTURES.md part B).

Everything is a projection of a given table, so the fixtures grow with it and
need no shuffle. Numbers are integer arithmetic or doubles that are exact in
binary or already hold two decimals, so aggregates do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.contract import FILE_MONTH


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _seconds(expr: Column) -> Column:
    return expr.cast("int")


def trips_raw(spark: SparkSession, sf_dir: str, null_pickup_every: int | None = None) -> DataFrame:
    """B1: one raw trip per lineitem row, 19 columns as published plus the file month.

    About 1 row in 1,000 has its pickup 60 days earlier than its file month; five
    columns are null together on every 21st order; ``l_returnflag = 'R'`` line 7
    carries a negative total. ``null_pickup_every`` blanks the pickup of every
    n-th order, the case only the mart's not-null test catches.
    """
    li = table(spark, sf_dir, "lineitem")
    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    early = F.when(ok % 997 == 0, F.lit(5_184_000)).otherwise(F.lit(0))
    pickup = F.timestamp_add(
        "SECOND", _seconds((pk * 37 + sk * 61 + ln * 7919) % 86400 - early), F.col("l_shipdate")
    )
    late = F.when(pk % 499 == 0, F.lit(90_000)).otherwise(F.lit(0))
    five_null = ok % 21 == 0

    def unless_null(value: Column) -> Column:
        return F.when(~five_null, value)

    shown_pickup = pickup if null_pickup_every is None else F.when(ok % null_pickup_every != 0, pickup)
    return li.select(
        (ln % 3 + 1).cast("bigint").alias("VendorID"),
        F.date_format("l_shipdate", "yyyy-MM").alias(FILE_MONTH),
        shown_pickup.alias("tpep_pickup_datetime"),
        F.timestamp_add("SECOND", _seconds((ok * 7 + pk * 13) % 5400 - 30 + late), pickup).alias(
            "tpep_dropoff_datetime"
        ),
        unless_null((ln - 1).cast("bigint")).alias("passenger_count"),
        F.when(sk % 50 == 0, F.lit(0.0)).otherwise(F.col("l_quantity") / F.lit(4.0)).alias("trip_distance"),
        unless_null(ln.cast("bigint")).alias("RatecodeID"),
        unless_null(F.when(F.col("l_linestatus") == "F", "N").otherwise("Y")).alias("store_and_fwd_flag"),
        (pk % 27 + 1).cast("bigint").alias("PULocationID"),
        (sk % 27 + 1).cast("bigint").alias("DOLocationID"),
        (ok % 4 + 1).cast("bigint").alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.col("l_discount").alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        F.when((F.col("l_returnflag") == "R") & (ln == 7), -F.col("l_extendedprice"))
        .otherwise(F.col("l_extendedprice"))
        .alias("total_amount"),
        unless_null(F.lit(2.5)).alias("congestion_surcharge"),
        unless_null(F.lit(1.25)).alias("Airport_fee"),
    )


# --- Fixed values: the two zones that are data, not nulls ------------------
UNKNOWN_ZONES = [
    (26, "Unknown", "N/A", "N/A"),
    (27, "N/A", "Outside of NYC", "N/A"),
]
ZONE_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"
# ---------------------------------------------------------------------------


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: 25 nation rows as zones 1..25 plus zones 26 and 27 (27 rows)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    named = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        (F.col("n_nationkey") + 1).cast("int").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.lit("Zone").alias("service_zone"),
    )
    return named.unionByName(spark.createDataFrame(UNKNOWN_ZONES, ZONE_SCHEMA))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 source listing: (key, status, etag, declared_size); 403 on every 17th key."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").alias("key"),
        F.when(F.col("doc_id") % 17 == 0, F.lit(403)).otherwise(F.lit(200)).alias("status"),
        F.md5("text").alias("etag"),
        F.col("n_chars").alias("declared_size"),
    )


def listing_with_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 with failing statuses on every 19th key and no declared size on every 23rd."""
    return listing(spark, sf_dir).withColumns({
        "status": F.when(F.col("key") % 19 == 0, F.lit(500)).otherwise(F.col("status")),
        "declared_size": F.when(F.col("key") % 23 != 0, F.col("declared_size")),
    })


def flagged_month(raw: DataFrame, month: str) -> DataFrame:
    """The rows of one file month with their totals turned negative: all are flagged."""
    return raw.where(F.col(FILE_MONTH) == month).withColumn("total_amount", -F.abs("total_amount") - F.lit(1.0))


def months_in_variants(raw: DataFrame) -> dict[str, DataFrame]:
    """The raw months as files that differ, by month number modulo 5: as published;
    other case and narrower ids; two columns absent; one column too many; money
    that does not fit the contract's type."""
    kind = F.substring(FILE_MONTH, 6, 2).cast("int") % 5
    parts = {name: raw.where(kind == i) for i, name in enumerate(("published", "case", "absent", "extra", "overflow"))}
    parts["case"] = parts["case"].withColumnsRenamed({"Airport_fee": "AIRPORT_FEE", "VendorID": "vendorid"}).withColumn(
        "PULocationID", F.col("PULocationID").cast("int")
    )
    parts["absent"] = parts["absent"].drop("tolls_amount", "RatecodeID")
    parts["extra"] = parts["extra"].withColumn("peaje_puente", F.lit(0.25))
    parts["overflow"] = parts["overflow"].withColumn(
        "fare_amount", F.when(F.col("VendorID") == 1, F.col("fare_amount") * 1e7).otherwise(F.col("fare_amount"))
    )
    return parts


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw filter texts, good and bad, one request for each order."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("pedido"),
        F.when(key % 7 == 0, F.col("o_orderpriority")).otherwise((F.col("o_custkey") % 40 - 5).cast("string")).alias("zona"),
        F.when(key % 11 == 0, "").otherwise((key % 30 - 3).cast("string")).alias("hora"),
        F.when(key % 13 == 0, "1_0").otherwise((key % 9 - 1).cast("string")).alias("limite"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 ledger of landed objects: keys not divisible by 3; every 5th has an old marker."""
    docs = table(spark, sf_dir, "documents")
    return docs.where(F.col("doc_id") % 3 != 0).select(
        F.col("doc_id").alias("key"),
        F.when(F.col("doc_id") % 5 == 0, F.md5(F.lit("old"))).otherwise(F.md5("text")).alias("etag"),
        F.col("n_chars").alias("size"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("landed_at"),
    )


def landed_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 objects as they arrived: (key, length) with the *byte* length of the body."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("key"), F.octet_length("text").cast("bigint").alias("length"))


def published_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months the source publishes: those with trips (lineitem ship months)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.date_format("l_shipdate", "yyyy-MM").alias("mes")).distinct()


def landed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months already in the ledger: order months (a shorter, earlier range)."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("mes")).distinct()


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows whose hourly file was landed; files of chosen hours are missing.

    Dropped on purpose: hour 4 of every day of the month divisible by 5, and
    hour 13 of the 11th.
    """
    ev = table(spark, sf_dir, "events")
    hour, day = F.hour("ts"), F.dayofmonth("ts")
    dropped = ((day % 5 == 0) & (hour == 4)) | ((day == 11) & (hour == 13))
    return ev.where(~dropped)
