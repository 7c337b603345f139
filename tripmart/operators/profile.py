"""Profiles of silver and gold: the counts the reference quotes, as queries.

All of them are aggregations with map-side partial combine (the exact percentiles a
few in a row); none groups rows into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.functions.flags import FLAG_NAMES, MONTH, any_flag, duration_seconds
from tripmart.functions.ordered import from_key, with_order_key
from tripmart.session import shared_dir

# Columns that the source leaves null together (with passenger_count).
NULL_TOGETHER = ("passenger_count", "ratecode_id", "store_and_fwd_flag", "congestion_surcharge", "airport_fee")
# Bits of one digit of the rank selection; a divisor of 64.
DIGIT_BITS = 16
# Rows of the state (one for each key and percentile, a few numbers each) to broadcast at most.
BROADCAST_STATE = 100_000
SPEED_QUANTILES = (0.5, 0.999)


def flag_profile(silver: DataFrame) -> DataFrame:
    """A2 + A4: rows, flagged rows and one count per flag, in one pass."""
    return silver.agg(
        F.count(F.lit(1)).alias("filas"),
        F.count_if(any_flag()).alias("marcadas"),
        *[F.count_if(F.col(n)).alias(n) for n in FLAG_NAMES],
    )


def flag_profile_by_month(silver: DataFrame) -> DataFrame:
    """A4 per partition: rows, flagged rows and one count per flag for every month."""
    return silver.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("filas"),
        F.count_if(any_flag()).alias("marcadas"),
        *[F.count_if(F.col(n)).alias(n) for n in FLAG_NAMES],
    )


def out_of_month(silver: DataFrame) -> DataFrame:
    """A6 per month: rows whose pickup falls outside the partition month."""
    outside = F.date_format("pickup_datetime", "yyyy-MM") != F.col(MONTH)
    return silver.groupBy(MONTH).agg(F.count_if(outside).alias("fuera"))


def flagged_share(silver: DataFrame) -> DataFrame:
    """A2 per month: rows, flagged rows, flagged percentage (2 decimals)."""
    by_month = silver.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("filas"), F.count_if(any_flag()).alias("marcadas")
    )
    return by_month.withColumn("pct_marcadas", F.round(F.col("marcadas") * F.lit(100.0) / F.col("filas"), 2))


def gold_totals(mart: DataFrame) -> DataFrame:
    """Trips, income (exact decimal) and distance rounded to cents."""
    return mart.agg(
        F.sum("viajes").alias("viajes"),
        F.sum("ingreso").alias("ingreso"),
        F.round(F.sum("distancia_total"), 2).alias("distancia"),
    )


def gold_domain(mart: DataFrame) -> DataFrame:
    """A8 + A9: distinct zones, hours and months, hour range.

    ``count(distinct)`` on a low-cardinality key: the distinct sets are bounded
    by the domain (zones, 24 hours, months), not by the data.
    """
    return mart.agg(
        F.count_distinct("pu_location_id").alias("zonas"),
        F.count_distinct("hora").alias("horas"),
        F.min("hora").alias("hora_min"),
        F.max("hora").alias("hora_max"),
        F.count_distinct(MONTH).alias("meses"),
    )


def implied_mph(silver: DataFrame) -> DataFrame:
    """Implied speed of every row with a positive duration (double arithmetic)."""
    dur = duration_seconds()
    mph = F.when(dur > 0, F.try_divide(F.col("trip_distance"), dur.cast("double") / F.lit(3600.0)))
    return silver.select(F.col(MONTH), mph.alias("mph")).where(F.col("mph").isNotNull())


def exact_ranks(values: DataFrame, key: str, value: str, quantiles: Sequence[float]) -> DataFrame:
    """(key, q, n, <value>): the value at rank ceil(q * n) of each key's sorted values.

    Radix selection over the order-preserving bits of a double, ``DIGIT_BITS`` at a time from
    the front, so the rounds are 64 / DIGIT_BITS whatever the values. The input is read twice:
    once to count the first digits, once to gather the distinct values (with their counts) that
    share a first digit with a wanted rank; the other digits are counted among those. Every
    count is a partial aggregation, and no key is sorted in one task.
    """
    spark = values.sparkSession
    shared_dir(spark)
    known = values.where(F.col(value).isNotNull() & ~F.isnan(value)).select(F.col(key).alias("k"), F.col(value).alias("x"))
    bits = with_order_key(known, "x", "bits")
    first = F.shiftright("bits", 64 - DIGIT_BITS)
    by_digit = Window.partitionBy("k").orderBy("prefix")  # at most 2^DIGIT_BITS rows
    counted = bits.groupBy("k", first.alias("prefix")).agg(F.count(F.lit(1)).alias("m"))
    counted = counted.withColumn("upto", F.sum("m").over(by_digit)).withColumn("n", F.sum("m").over(Window.partitionBy("k")))
    state = counted.select(
        "*", F.explode(F.array(*[F.lit(q) for q in quantiles])).alias("q")
    ).withColumn("r", F.greatest(F.ceil(F.col("q") * F.col("n")), F.lit(1)))
    state = _holding(state).checkpoint()
    # one row for each key and quantile; broadcast only when that is known to be small
    beside = F.broadcast if state.count() <= BROADCAST_STATE else (lambda df: df)
    near = beside(state.select("k", "prefix").distinct())
    few = (
        bits.withColumn("prefix", first).join(near, ["k", "prefix"]).groupBy("k", "bits").agg(F.count(F.lit(1)).alias("m")).checkpoint()
    )
    for left in range(64 - 2 * DIGIT_BITS, -1, -DIGIT_BITS):
        state = state.withColumnRenamed("prefix", "above")
        inside = few.withColumn("above", F.shiftright("bits", left + DIGIT_BITS)).join(beside(state), ["k", "above"])
        digits = inside.groupBy("k", "q", "n", "r", F.shiftright("bits", left).alias("prefix")).agg(F.sum("m").alias("m"))
        upto = F.sum("m").over(Window.partitionBy("k", "q").orderBy("prefix"))  # at most 2^DIGIT_BITS rows
        state = _holding(digits.withColumn("upto", upto))
    return state.select(F.col("k").alias(key), "q", "n", from_key(F.col("prefix")).alias(value))


def _holding(digits: DataFrame) -> DataFrame:
    """The digits that hold their rank, and the rank inside them."""
    before = F.col("upto") - F.col("m")
    held = digits.where((F.col("upto") >= F.col("r")) & (before < F.col("r")))
    return held.select("k", "q", "n", (F.col("r") - before).alias("r"), "prefix")


def speed_profile(silver: DataFrame) -> DataFrame:
    """A11 per month: p50, p99.9 and max of implied mph, with the row count.

    A percentile is the value at rank ceil(q * n) of the month's sorted speeds, the
    maximum that at rank n.
    """
    ranks = exact_ranks(implied_mph(silver), MONTH, "mph", (*SPEED_QUANTILES, 1.0))
    at = {q: F.max(F.when(F.col("q") == q, F.col("mph"))) for q in (*SPEED_QUANTILES, 1.0)}
    p50, p999 = SPEED_QUANTILES
    return ranks.groupBy(MONTH).agg(
        F.max("n").alias("n"), at[p50].alias("mph_p50"), at[p999].alias("mph_p999"), at[1.0].alias("mph_max")
    )


def negative_by_payment(silver: DataFrame) -> DataFrame:
    """Reversals (negative totals) by payment type."""
    return (
        silver.where(F.col("total_amount") < 0)
        .groupBy("payment_type")
        .agg(F.count(F.lit(1)).alias("viajes"), F.sum("total_amount").alias("importe"))
    )


def null_pattern(columns=NULL_TOGETHER):
    return F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])


def null_together(silver: DataFrame) -> DataFrame:
    """Rows by vendor and by which of the five columns are null."""
    return silver.groupBy("vendor_id", null_pattern().alias("patron_nulos")).agg(
        F.count(F.lit(1)).alias("filas")
    )


def flagged_with_null_passengers(silver: DataFrame) -> DataFrame:
    """Flagged share as is, and if a null passenger count were flagged too."""
    wider = any_flag() | F.col("passenger_count").isNull()
    agg = silver.agg(
        F.count(F.lit(1)).alias("filas"),
        F.count_if(any_flag()).alias("marcadas"),
        F.count_if(wider).alias("marcadas_con_nulos"),
    )
    pct = lambda c: F.round(F.col(c) * F.lit(100.0) / F.col("filas"), 2)
    return agg.select("filas", "marcadas", "marcadas_con_nulos",
                      pct("marcadas").alias("pct_marcadas"), pct("marcadas_con_nulos").alias("pct_con_nulos"))


def distance_outlier(silver: DataFrame) -> DataFrame:
    """The longest trip and its duration (ties broken by the rest of the key)."""
    dur = duration_seconds()
    key = F.struct("trip_distance", "pickup_datetime", "dropoff_datetime", MONTH)
    best = silver.agg(F.max_by(F.struct(key.alias("k"), dur.alias("duracion_seg")), key).alias("b"))
    return best.select(
        F.col("b.k.trip_distance").alias("trip_distance"),
        F.col("b.k.pickup_datetime").alias("pickup_datetime"),
        F.col("b.k.dropoff_datetime").alias("dropoff_datetime"),
        F.col(f"b.k.{MONTH}").alias(MONTH),
        F.col("b.duracion_seg").alias("duracion_seg"),
    )
