"""Keys in the order of doubles, and exact ranks by them."""

import math
import struct
import time

import numpy as np
from pyspark.sql import functions as F

from tripmart.functions.ordered import from_key, with_order_key
from tripmart.operators import profile

EDGES = [0.0, -0.0, 5e-324, 2.0**-1074 * 3, 2.0**-1022, 2.0**-1022 - 5e-324, 2.0**-1021, 1.0, 1.0 - 2**-53, 1.0 + 2**-52, 2.0, 3.0,
         2.0**52, 2.0**53 - 1, 2.0**1023, 1.7976931348623157e308, math.inf, 1e-308, 1e-320, 0.1, 9.57, 1_443_333.0]


def ieee(x):
    bits = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -bits if x < 0 else bits


def test_keys_are_the_bits_of_the_number(spark):
    rng = np.random.default_rng(1)
    drawn = rng.integers(0, 0x7FF0000000000000, 4000, dtype=np.int64).view(np.float64).tolist()
    powers = [2.0**e * s for e in range(-1074, 1024, 7) for s in (1.0, 1.0 + 2**-52, 2.0 - 2**-52) if 2.0**e * s < math.inf]
    values = [s * x for x in EDGES + drawn + powers for s in (1.0, -1.0)]
    df = with_order_key(spark.createDataFrame([(x, x) for x in values], "x double, y double"), "y", "k")
    for x, k, back in df.select("x", "k", from_key(F.col("k")).alias("back")).collect():
        assert k == ieee(x) and back == x


def ranks(values, qs):
    v = sorted(values)
    return {q: (len(v), v[max(1, math.ceil(q * len(v))) - 1]) for q in qs}


def test_values_over_the_whole_range_take_the_same_rounds(spark):
    rng = np.random.default_rng(2)
    values = (2.0 ** rng.uniform(-900, 900, 120_000) * rng.choice([-1.0, 1.0], 120_000)).tolist()
    df = spark.createDataFrame([(x,) for x in values], "x double").selectExpr("'a' AS k", "x").repartition(8)
    qs = (0.001, 0.5, 0.999, 1.0)
    before = time.time()
    got = {r.q: (r.n, r.x) for r in profile.exact_ranks(df, "k", "x", qs).collect()}
    assert got == ranks(values, qs)
    assert time.time() - before < 60


def test_equal_and_odd_values(spark):
    groups = {"same": [9.57] * 5000, "two": [1.0, math.nextafter(1.0, 2)] * 40, "one": [-3.0], "signs": [-1.0, -0.0, 0.0, 5e-324, math.inf, -math.inf]}
    rows = [(k, x) for k, xs in groups.items() for x in xs] + [("same", None), ("one", math.nan), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    qs = (0.0, 0.5, 0.999, 1.0)
    got = {(r.k, r.q): (r.n, r.x) for r in profile.exact_ranks(df, "k", "x", qs).collect()}
    assert got == {(k, q): at for k, xs in groups.items() for q, at in ranks(xs, qs).items()}
    assert profile.exact_ranks(df.limit(0), "k", "x", qs).count() == 0
