"""A long for each double, in the same order: the bits of the number as an integer.

Built-in arithmetic only, exact throughout: powers of two are exact, and dividing by one
loses no bit, so the exponent and the fraction come apart without a cast of bits.
Negative numbers are the negated key of their absolute value; 0.0 and -0.0 share a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FRACTION_BITS = 52
BIAS = 1023
LEAST_EXPONENT = 1 - BIAS  # below it, numbers are multiples of 2^-1074
INFINITE = (2 * BIAS + 1) << FRACTION_BITS


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent.cast("double"))


def with_order_key(df: DataFrame, value: str, key: str) -> DataFrame:
    """``df`` with the column ``key`` in place of the double column ``value``, which is neither null nor NaN.

    One projection a step, so that the logarithm and the power are evaluated once a row.
    """
    rest = [c for c in df.columns if c != value]
    x, size, e, p, shift = (F.col(f"__{c}") for c in ("x", "size", "e", "p", "shift"))
    # the logarithm may round either way, and is null for zero
    near = F.floor(F.least(F.greatest(F.log2(size), F.lit(float(LEAST_EXPONENT))), F.lit(float(BIAS)))).cast("int")
    steps = (
        df.select(*rest, F.col(value).alias("__x"), F.abs(value).alias("__size"))
        .select(*rest, "__x", "__size", near.alias("__e"))
        .select(*rest, "__x", "__size", "__e", _power(e).alias("__p"))
        .withColumn("__shift", F.when((p > size) & (e > LEAST_EXPONENT), -1).when((p <= size / 2) & (e < BIAS), 1).otherwise(0))
    )
    exact = F.when(shift < 0, p / 2).when(shift > 0, p * 2).otherwise(p)
    # in [1, 2) from the least exponent on, in [0, 1) below: the hidden bit counts the exponent up by itself
    scaled = (F.when(size == float("inf"), p).otherwise(size) / exact * F.lit(float(1 << FRACTION_BITS))).cast("long")
    bits = (e + shift + F.lit(BIAS - 1)).cast("long") * F.lit(1 << FRACTION_BITS) + scaled
    bits = F.when(size == 0, F.lit(0).cast("long")).when(size == float("inf"), F.lit(INFINITE)).otherwise(bits)
    signed = F.when(x < 0, -F.col("__bits")).otherwise(F.col("__bits"))
    # never null, so that no join on it puts a copy of all these steps into a filter below them
    return steps.select(*rest, "__x", bits.alias("__bits")).select(*rest, F.coalesce(signed, F.lit(0)).alias(key))


def from_key(key: Column) -> Column:
    """The double of a key."""
    size = F.abs(key)
    exponent = F.shiftright(size, FRACTION_BITS)
    fraction = size.bitwiseAND(F.lit((1 << FRACTION_BITS) - 1)).cast("double") / F.lit(float(1 << FRACTION_BITS))
    value = (
        F.when(size == INFINITE, F.lit(float("inf")))
        .when(exponent == 0, fraction * _power(F.lit(LEAST_EXPONENT)))
        .otherwise((fraction + 1.0) * _power(exponent - BIAS))
    )
    return F.when(key < 0, -value).otherwise(value)
