"""Backfills over months whose files differ: case, integer widths, extras, missing columns."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tripmart.lake import Lake
from tripmart.operators import contract as C
from tripmart.operators import silver
from tripmart.session import scratch
from tripmart.sources import fixtures


def _write_month(df, lake, month):
    df.drop(C.FILE_MONTH).write.mode("overwrite").parquet(lake.raw("yellow", month))


@pytest.fixture(scope="module")
def raw(spark):
    return fixtures.trips_raw(spark, SF_SMALL).cache()


def test_months_with_different_schemas_resolve_each_on_its_own(spark, raw):
    lake = Lake(scratch(spark, "schemas"))
    a, b, c = "1996-01", "1996-02", "1996-03"
    _write_month(raw.where(F.col(C.FILE_MONTH) == a), lake, a)
    # b: another spelling of one column, int32 instead of int64 ids, one extra column
    variant = (
        raw.where(F.col(C.FILE_MONTH) == b)
        .withColumnRenamed("Airport_fee", "AIRPORT_fee")
        .withColumn("PULocationID", F.col("PULocationID").cast("int"))
        .withColumn("recargo_nocturno", F.lit(0.75))
    )
    _write_month(variant, lake, b)
    # c: one value too large for decimal(10,2) -> null, counted
    big = raw.where(F.col(C.FILE_MONTH) == c).withColumn(
        "fare_amount", F.when(F.col("VendorID") == 1, F.lit(1e12)).otherwise(F.col("fare_amount"))
    )
    _write_month(big, lake, c)

    expected = {m: raw.where(F.col(C.FILE_MONTH) == m).count() for m in (a, b, c)}
    report = silver.materialize(spark, lake, "yellow", [a, b, c])
    assert {m: n.silver for m, n in report.by_month.items()} == expected and not report.unequal
    assert report.extras == ("recargo_nocturno",)
    assert report.cast_nulls["fare_amount"] == raw.where(
        (F.col(C.FILE_MONTH) == c) & (F.col("VendorID") == 1)
    ).count() > 0
    table = spark.read.parquet(lake.silver("yellow"))
    assert dict(table.dtypes)["pu_location_id"] == "int"
    # the column in another case was read, not left null
    assert table.where((F.col("mes") == b) & F.col("airport_fee").isNotNull()).count() > 0


def test_a_month_missing_columns_fails_by_name_before_writing(spark, raw):
    lake = Lake(scratch(spark, "schemas-missing"))
    good, bad = "1997-01", "1997-02"
    _write_month(raw.where(F.col(C.FILE_MONTH) == good), lake, good)
    _write_month(raw.where(F.col(C.FILE_MONTH) == bad).drop("congestion_surcharge"), lake, bad)
    with pytest.raises(C.ContractError, match="congestion_surcharge"):
        silver.materialize(spark, lake, "yellow", [good, bad])
    from tripmart.lake import table_exists

    assert not table_exists(spark, lake.silver("yellow"))


def test_an_empty_month_is_refused_and_nothing_is_written(spark, raw):
    lake = Lake(scratch(spark, "schemas-empty"))
    _write_month(raw.where(F.lit(False)), lake, "1998-05")
    with pytest.raises(silver.EmptyMonth):
        silver.materialize(spark, lake, "yellow", "1998-05")
