import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import ledgerspark.operators.quantile as Q
from ledgerspark.operators.quantile import key_value, order_key, percentile


@settings(max_examples=12, deadline=None, derandomize=True)
@given(
    st.lists(st.integers(0, 40), min_size=1, max_size=120),
    st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 0.997, 1.0]),
)
def test_percentile_matches_numpy(spark, ints, q):
    values = [i / 7.0 for i in ints]
    df = spark.createDataFrame([(v,) for v in values], "s double")
    assert percentile(df, "s", q) == pytest.approx(float(np.percentile(values, q * 100)), rel=0, abs=1e-12)


def test_percentile_edge_cases(spark):
    one = spark.createDataFrame([(0.3,)], "s double")
    assert percentile(one, "s", 0.9) == 0.3
    same = spark.createDataFrame([(2.0,)] * 5, "s double")
    assert percentile(same, "s", 0.5) == 2.0
    empty = spark.createDataFrame([], "s double")
    assert percentile(empty, "s", 0.5) is None
    wide = [1e-9 * i for i in range(50)] + [1e9]
    df = spark.createDataFrame([(v,) for v in wide], "s double")
    assert percentile(df, "s", 0.5) == float(np.percentile(wide, 50))


def test_order_key_is_the_bit_pattern(spark):
    import random
    import struct

    from pyspark.sql import functions as F

    rng = random.Random(3)
    values = [0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, float("inf")]
    values += [2.0**k for k in range(-1074, 1024)] + [math.nextafter(2.0**k, 0) for k in range(-1073, 1024, 3)]
    values += [struct.unpack("<d", struct.pack("<q", rng.randrange(0x7FF << 52)))[0] for _ in range(2000)]
    df = spark.createDataFrame([(s * v,) for v in values for s in (1.0, -1.0)], "s double")
    for r in df.select("s", order_key(F.col("s")).alias("k")).collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(r.s)))[0]
        assert r.k == (bits if r.s >= 0 else -bits), r.s
        assert key_value(r.k) == r.s


def test_tiny_values_and_an_outlier(spark, monkeypatch):
    """300 000 distinct values in a range that one outlier makes look empty:
    no level sends more than 65 536 rows."""
    from pyspark.sql import functions as F

    seen = []
    monkeypatch.setattr(Q, "_locate", lambda counts, rank, f=Q._locate: seen.append(len(counts)) or f(counts, rank))
    small = spark.range(300_000).select((F.col("id") * 1e-12).alias("s"))
    df = small.unionByName(spark.range(1).select(F.lit(1e30).alias("s")))
    got = percentile(df, "s", 0.5)
    assert got == 150_000 * 1e-12 and max(seen) <= 1 << 16


def test_hot_value_and_signs(spark):
    values = [((i * 7919) % 1000 - 500) / 3.0 for i in range(2000)] + [5.0] * 1000
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "s double")
    for q in (0.0, 0.3, 0.5, 0.97, 1.0):
        assert percentile(df, "s", q) == pytest.approx(float(np.percentile(values, q * 100)), abs=1e-12)


def test_the_column_is_computed_once_for_all_levels(spark):
    n, computed = 300, spark.sparkContext.accumulator(0)

    def value(k):
        computed.add(1)
        return k / 7

    df = spark.range(n).select(F.udf(value, "double")("id").alias("x"))
    assert percentile(df, "x", 0.5) == np.quantile(np.arange(n) / 7, 0.5)
    assert computed.value <= 2 * n  # counted, then stored
