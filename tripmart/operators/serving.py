"""Serving: filtered, limited questions on the mart.

A filter is validated before any query is built, so a bad filter is an error,
never an empty answer. Results are ordered by the grain so a limit repeats.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.flags import MONTH
from tripmart.operators.gold import GRAIN

INT32_MIN, INT32_MAX = -(2**31), 2**31 - 1

# --- Fixed values: the mart's columns, and the names of the JSON answer --------
# Strict types at the serving edge (S5): name -> accepted type.
MART_TYPES = {
    MONTH: T.StringType(),
    "pu_location_id": T.IntegerType(),
    "hora": T.IntegerType(),
    "viajes": T.LongType(),
    "ingreso": T.DecimalType,  # any precision; scale checked below
    "distancia_total": T.DoubleType(),
    "duracion_media_seg": T.DoubleType(),
}
# ---------------------------------------------------------------------------

# Why a filter is refused (F13), by parameter.
REFUSALS = {
    "zona": "zona takes a whole number of 32 bits",
    "hora": "hora takes a whole number from 0 to 23",
    "limite": "limite takes a whole number that is not negative",
}


class InvalidFilter(ValueError):
    pass


class MartSchemaError(TypeError):
    pass


_WHOLE = r"[+-]?[0-9]+"


def _whole(value: str | int | None, name: str, low: int, high: int | None) -> int | None:
    """The number in ``value`` if it is within bounds; '' and None mean not given."""
    if value is None or value == "":
        return None
    digits = isinstance(value, str) and re.fullmatch(_WHOLE, value)
    if isinstance(value, bool) or not (digits or isinstance(value, int)):
        raise InvalidFilter(REFUSALS[name])
    number = int(value)
    if number < low or (high is not None and number > high):
        raise InvalidFilter(REFUSALS[name])
    return number


def refusal(zona: Column, hora: Column, limite: Column) -> Column:
    """F13 over columns of raw filter texts: why a request is refused, or null."""

    def outside(value, low, high):
        given = value.isNotNull() & (value != "")
        number = value.try_cast("decimal(38,0)")
        fine = value.rlike(f"^{_WHOLE}$") & number.isNotNull() & (number >= low)
        return given & ~F.coalesce(fine & (number <= high) if high is not None else fine, F.lit(False))

    return (
        F.when(outside(zona, INT32_MIN, INT32_MAX), REFUSALS["zona"])
        .when(outside(hora, 0, 23), REFUSALS["hora"])
        .when(outside(limite, 0, None), REFUSALS["limite"])
    )


@dataclass(frozen=True)
class TripFilter:
    """Optional equality on month, zone and hour; ``limit`` 0 means all rows."""

    month: str | None = None
    zone: int | None = None
    hour: int | None = None
    limit: int = 0

    @classmethod
    def parse(cls, mes=None, zona=None, hora=None, limite=None) -> TripFilter:
        """Validate raw query values. The month is not validated: an unknown month
        simply matches nothing."""
        zone = _whole(zona, "zona", INT32_MIN, INT32_MAX)
        hour = _whole(hora, "hora", 0, 23)
        limit = _whole(limite, "limite", 0, None) or 0
        return cls(month=mes or None, zone=zone, hour=hour, limit=limit)

    def apply(self, mart: DataFrame) -> DataFrame:
        """ANDed equalities; pushed to the mart scan and pruned by month."""
        out = mart
        if self.month is not None:
            out = out.where(F.col(MONTH) == self.month)
        if self.zone is not None:
            out = out.where(F.col("pu_location_id") == self.zone)
        if self.hour is not None:
            out = out.where(F.col("hora") == self.hour)
        return out


def trips(mart: DataFrame, flt: TripFilter) -> DataFrame:
    """Q1: matching rows in grain order, limited, with ``total`` = rows matching.

    The rows returned are the answer (their count is what the API reports as
    returned); ``total`` is a scalar subquery evaluated once, not a join, and a
    positive limit plans as a top-k (``TakeOrderedAndProject``), not a full sort.
    """
    chosen = flt.apply(mart)
    total = chosen.select(F.count(F.lit(1))).scalar()
    rows = chosen.orderBy(*GRAIN)
    if flt.limit > 0:
        rows = rows.limit(flt.limit)
    return rows.select(
        F.col(MONTH),
        F.col("pu_location_id").alias("zona"),
        "hora",
        "viajes",
        "ingreso",
        "distancia_total",
        "duracion_media_seg",
        total.alias("total"),
    )


def as_json(rows: DataFrame) -> DataFrame:
    """Q2: one JSON object per row; income is quoted text with its exact scale."""
    return rows.select(
        F.to_json(
            F.struct(
                F.col(MONTH),
                F.col("zona"),
                F.col("hora"),
                F.col("viajes"),
                F.col("ingreso").cast("string").alias("ingreso"),
                F.col("distancia_total"),
                F.col("duracion_media_seg"),
            )
        ).alias("json")
    )


def state(mart: DataFrame) -> DataFrame:
    """Q3: status and row count of the mart; reading a broken mart raises."""
    return mart.agg(F.lit("ok").alias("estado"), F.count(F.lit(1)).alias("filas"))


def check_mart_schema(mart: DataFrame) -> DataFrame:
    """Select the mart's columns by name and assert their types."""
    fields = {f.name: f.dataType for f in mart.schema.fields}
    problems = []
    for name, expected in MART_TYPES.items():
        if name not in fields:
            problems.append(f"missing column {name}")
            continue
        got = fields[name]
        if expected is T.DecimalType:
            if not isinstance(got, T.DecimalType) or got.scale != 2:
                problems.append(f"{name}: expected decimal(_,2), found {got.simpleString()}")
        elif got != expected:
            problems.append(f"{name}: expected {expected.simpleString()}, found {got.simpleString()}")
    if problems:
        raise MartSchemaError("; ".join(problems))
    return mart.select(*MART_TYPES)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    return check_mart_schema(spark.read.parquet(path))
