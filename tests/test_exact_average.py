"""Averages whose bits don't depend on the order of the rows."""

import math
import random
import struct
from fractions import Fraction

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from alloy.operators.aggregate import centroid, exact_average


def bits(x):
    return None if x is None else struct.pack("<d", x + 0.0)


def want(values):
    got = [v for v in values if v is not None]
    if not got:
        return None
    if any(math.isnan(v) or math.isinf(v) for v in got):
        return sum(v for v in got if math.isnan(v) or math.isinf(v)) / len(got)
    try:
        return float(sum(map(Fraction, got))) / len(got)
    except OverflowError:
        return math.inf


def averages(spark, groups):
    data = [(g, v) for g, vs in enumerate(groups) for v in vs]
    random.Random(4).shuffle(data)
    df = spark.createDataFrame(data, "g int, v double")
    return {r["g"]: r["v"] for r in exact_average(df, ["g"], ["v"]).collect()}


FINITE = st.floats(allow_nan=False, allow_infinity=False, min_value=-1e300, max_value=1e300)
ANY = st.one_of(FINITE, st.floats(min_value=-1e4, max_value=1e4), st.sampled_from([0.0, 5e-324, -5e-324, 2.0 ** -1022, 1e16, 1.0, -1e16, 0.1]))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.one_of(st.none(), ANY), min_size=1, max_size=20), min_size=1, max_size=30))
def test_property_sums_are_rounded_once(spark, groups):
    got = averages(spark, groups)
    for g, vs in enumerate(groups):
        assert bits(got[g]) == bits(want(vs)), vs


def test_cancellation_powers_of_two_and_odd_values(spark):
    nan, inf = float("nan"), float("inf")
    groups = [[1e300, 1.0, -1e300], [2.0 ** k for k in range(-60, 60)], [-(2.0 ** k) for k in range(-1074, 1000, 37)],
              [2.0 ** 53, 1.0, 1.0], [2.0 ** 53, 1.0], [2.0 ** 53, 1.0, 5e-324], [0.1] * 10, [-0.1] * 7 + [0.3], [0.0, 0.0],
              [inf, 1.0], [inf, -inf], [nan, 1.0], [-inf, 5.0], [None, None], [None, 3.0],
              [255.99999999999997, 256.0, 256.00000000000006], [1.7e308, 1.7e308, -1.7e308]]
    got = averages(spark, groups)
    for g, vs in enumerate(groups):
        w = want(vs)
        assert (math.isnan(got[g]) if w is not None and math.isnan(w) else bits(got[g]) == bits(w)), (vs, got[g], w)


@pytest.mark.parametrize("keys", [["zip", "city", "state"]])
def test_three_repartitions_give_equal_bits(spark, keys):
    n = F.col("id")
    df = spark.range(20_000).select(
        (n % 5).alias("zip"), F.when(n % 3 == 0, "a").alias("city"), F.lit("s").alias("state"),
        (F.rand(1) * F.pow(F.lit(10.0), (n % 17).cast("int")) - 50).alias("lat"), (F.randn(2) / 3).alias("lng"))
    df.write.mode("overwrite").parquet(path := _scratch(spark))
    got = []
    for parts in (1, 7, 40):
        one = centroid(spark.read.parquet(path).repartition(parts, F.rand(parts)), "zip", "lat", "lng", "city", "state")
        got.append({tuple(r[:3]): (bits(r["lat"]), bits(r["lng"])) for r in one.collect()})
    assert got[0] == got[1] == got[2] and len(got[0]) == 10
    plain = {tuple(r[:3]): r["lat"] for r in spark.read.parquet(path).groupBy(*keys).agg(F.avg("lat").alias("lat")).collect()}
    for k, (lat, _) in got[0].items():
        assert abs(struct.unpack("<d", lat)[0] / plain[k] - 1) < 1e-9


def _scratch(spark):
    from alloy.session import scratch_path
    return scratch_path(spark, "exact")


def test_names_and_column_keys(spark):
    df = spark.createDataFrame([(1, 2.0, 5), (1, 4.0, None)], "k int, x double, y int")
    got = exact_average(df, [(F.col("k") * 2).alias("kk")], ["x", "y"], ["mx", "my"])
    assert got.columns == ["kk", "mx", "my"] and rows(got) == [(2, 3.0, 5.0)]
    assert exact_average(df.limit(0), ["k"], ["x"]).count() == 0
