"""Randomised checks of the column helpers against independent references."""

import datetime as dt
import math

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripdemand.functions import boundary_diff, round_half_away, round_half_even

_T0 = dt.datetime(2023, 12, 1)
stamps = st.integers(min_value=0, max_value=200 * 86_400 * 1_000_000).map(
    lambda us: _T0 + dt.timedelta(microseconds=us))


def _floor_seconds(t):
    return math.floor((t - _T0).total_seconds())


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(stamps, stamps), min_size=200, max_size=200))
def test_boundary_seconds_and_minutes_match_python(spark, pairs):
    df = spark.createDataFrame(pairs, "s timestamp_ntz, e timestamp_ntz")
    got = df.select(boundary_diff("second", F.col("s"), F.col("e")).alias("sec"),
                    boundary_diff("minute", F.col("s"), F.col("e")).alias("mins")).collect()
    for (s, e), r in zip(pairs, got):
        assert r.sec == _floor_seconds(e) - _floor_seconds(s)
        assert r.mins == (_floor_seconds(e) // 60) - (_floor_seconds(s) // 60)


money = st.integers(min_value=-10_000_000, max_value=10_000_000).map(lambda c: c / 1000.0)


@settings(max_examples=1, deadline=None)
@given(st.lists(money, min_size=300, max_size=300))
def test_rounding_matches_sql_and_numpy(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = df.select(round_half_away(F.col("x"), 2).alias("a"),
                    round_half_even(F.col("x"), 1).alias("e")).collect()
    con = duckdb.connect()
    want = con.execute("SELECT ROUND(x, 2), round_even(x * 10.0, 0) / 10.0 FROM "
                       "(SELECT UNNEST(?::DOUBLE[]) AS x)", [xs]).fetchall()
    for x, r, (a, e) in zip(xs, got, want):
        assert r.a == a, x
        assert r.e == e == float(np.round(x, 1)), x
