"""Data tests as queries that return violations: an empty result means it passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tripmart.functions.flags import FLAG_NAMES, MONTH, any_flag
from tripmart.operators.gold import GRAIN

NOT_NULL_COLUMNS = (MONTH, "pu_location_id", "hora", "viajes", "ingreso")
VIOLATION_SCHEMA = ("prueba", "sujeto", "violaciones")
TWO_DECIMALS = r"^-?\d+\.\d{2}$"


def not_null(df: DataFrame, columns: Sequence[str] = NOT_NULL_COLUMNS) -> DataFrame:
    """One row per column holding nulls (one pass over the table)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], list(columns), "sujeto", "violaciones")
    return long.where(F.col("violaciones") > 0).select(
        F.lit("not_null").alias("prueba"), "sujeto", "violaciones"
    )


def grain_unique(df: DataFrame, grain: Sequence[str] = GRAIN) -> DataFrame:
    """Grain values present more than once (``GROUP BY ... HAVING count(*) > 1``)."""
    dup = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("violaciones")).where(F.col("violaciones") > 1)
    return dup.select(
        F.lit("grain_unique").alias("prueba"),
        F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in grain]).alias("sujeto"),
        "violaciones",
    )


def not_empty(df: DataFrame) -> DataFrame:
    """D3: exactly one row when the table is empty."""
    n = df.agg(F.count(F.lit(1)).alias("n"))
    return n.where(F.col("n") == 0).select(
        F.lit("not_empty").alias("prueba"), F.lit("mart").alias("sujeto"), F.lit(1).cast("bigint").alias("violaciones")
    )


def mart_violations(mart: DataFrame, allow_empty: bool = False) -> DataFrame:
    """D1 + D2 + D3 over the mart; ``allow_empty`` leaves D3 out."""
    found = not_null(mart).unionByName(grain_unique(mart))
    return found if allow_empty else found.unionByName(not_empty(mart))


def violation_counts(violations: DataFrame) -> DataFrame:
    """One row per test that fails: on how many subjects, one of them, and violations in all.

    D2 names every duplicated grain; a broken mart may hold very many, so they are
    counted on the cluster and only these few rows reach a driver.
    """
    return violations.groupBy("prueba").agg(
        F.count(F.lit(1)).alias("sujetos"), F.min("sujeto").alias("ejemplo"),
        F.sum("violaciones").cast("bigint").alias("violaciones"),
    )


def gold_vs_silver(silver: DataFrame, mart: DataFrame) -> DataFrame:
    """D6 per month: clean silver rows (negated OR, F14) against gold's trips.

    Both sides are aggregated to one row per month before the join, so the join
    is between two small tables whatever the size of silver.
    """
    clean = silver.where(~any_flag()).groupBy(MONTH).agg(F.count(F.lit(1)).alias("limpias"))
    trips = mart.groupBy(MONTH).agg(F.sum("viajes").alias("viajes"))
    joined = clean.join(trips, MONTH, "full")
    return joined.select(
        MONTH,
        F.coalesce("limpias", F.lit(0)).alias("limpias"),
        F.coalesce("viajes", F.lit(0)).cast("bigint").alias("viajes"),
        (F.coalesce("limpias", F.lit(0)) == F.coalesce("viajes", F.lit(0))).alias("cuadra"),
    )


def flag_nulls(silver: DataFrame) -> DataFrame:
    """A5: null count per flag; all must be zero."""
    return silver.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in FLAG_NAMES])


def income_text(mart: DataFrame) -> DataFrame:
    """Income must be a decimal and print with exactly two decimals."""
    dtype = mart.schema["ingreso"].dataType
    if not isinstance(dtype, DecimalType) or dtype.scale != 2:
        raise TypeError(f"ingreso must be decimal(_,2), found {dtype.simpleString()}")
    return not_two_decimals(mart, "ingreso")


def not_two_decimals(rows: DataFrame, column: str) -> DataFrame:
    """Values of a column, of whatever type, that do not print with exactly two decimals."""
    text = F.col(column).cast("string")
    return rows.where(~text.rlike(TWO_DECIMALS)).select(
        F.lit("income_two_decimals").alias("prueba"), text.alias("sujeto"), F.lit(1).cast("bigint").alias("violaciones")
    )


def partition_counts(df: DataFrame) -> DataFrame:
    """Rows per month partition."""
    return df.groupBy(MONTH).agg(F.count(F.lit(1)).alias("record_count"))
