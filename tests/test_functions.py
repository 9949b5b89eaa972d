"""Edge rows for the column helpers and the cleaning rules (FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripdemand.functions import (boundary_diff, day_of_week_sun0, exact_mean, round_half_away,
                                  round_half_even, scaled_sum)
from tripdemand.operators import cleaning

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _ts_pairs(spark, pairs):
    return spark.createDataFrame(pairs, "s timestamp_ntz, e timestamp_ntz")


def test_boundary_seconds_counts_boundaries_not_elapsed(spark):
    df = _ts_pairs(spark, [(T0.replace(microsecond=900000), dt.datetime(2024, 1, 1, 0, 1, 0, 100000)),
                           (T0, T0 + dt.timedelta(seconds=59)),
                           (T0 + dt.timedelta(seconds=5), T0)])
    got = [r[0] for r in df.select(boundary_diff("second", F.col("s"), F.col("e"))).collect()]
    assert got == [60, 59, -5]


def test_boundary_minutes(spark):
    df = _ts_pairs(spark, [(T0 + dt.timedelta(seconds=59), T0 + dt.timedelta(seconds=61))])
    assert df.select(boundary_diff("minute", F.col("s"), F.col("e"))).first()[0] == 1


def test_boundary_diff_ignores_session_time_zone(spark):
    # a wall-clock span across the New York spring-forward gap
    df = _ts_pairs(spark, [(dt.datetime(2024, 3, 10, 1, 30), dt.datetime(2024, 3, 10, 3, 30))])
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = df.select(boundary_diff("second", F.col("s"), F.col("e"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == 7200


@pytest.mark.parametrize("x,expected", [(1.005, 1.0), (2.675, 2.68), (0.125, 0.13), (-2.675, -2.68)])
def test_round_half_away_is_binary(spark, x, expected):
    assert spark.range(1).select(round_half_away(F.lit(x), 2)).first()[0] == expected


# same values as pandas .round(1): 0.45 * 10 is exactly 4.5 in binary, so it goes to 4
@pytest.mark.parametrize("x,expected", [(0.25, 0.2), (0.35, 0.4), (0.45, 0.4), (-0.25, -0.2)])
def test_round_half_even(spark, x, expected):
    assert spark.range(1).select(round_half_even(F.lit(x), 1)).first()[0] == expected


def test_exact_mean_and_sum_are_order_free(spark):
    vals = [0.1, 0.2, 0.3, 12.34, 0.01, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(3)
    r = df.agg(exact_mean(F.col("x"), 2).alias("m"), scaled_sum(F.col("x"), 2).alias("s")).first()
    assert r["s"] == 12.95
    assert r["m"] == 1295 / 500


def test_weekday_sunday_zero(spark):
    df = spark.createDataFrame([(dt.date(2026, 1, 4),), (dt.date(2026, 1, 3),)], "d date")
    assert [r[0] for r in df.select(day_of_week_sun0(F.col("d"))).collect()] == [0, 6]


def _yellow_row(seconds, distance=1.0, fare=10.0, start=T0, pu=4, do=4):
    return (1, start, start + dt.timedelta(seconds=seconds), pu, do, distance, fare,
            1.0, 0.0, None, None, None, 12.0, "2024-01")


YELLOW_DDL = ("VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
              "PULocationID int, DOLocationID int, trip_distance double, fare_amount double, "
              "tip_amount double, tolls_amount double, congestion_surcharge double, Airport_fee double, "
              "cbd_congestion_fee double, total_amount double, file_month string")


def test_duration_bounds(spark):
    raw = spark.createDataFrame([_yellow_row(s) for s in (59, 60, 10800, 10801)], YELLOW_DDL)
    kept = sorted(r.trip_duration_min for r in cleaning.clean_yellow(raw).collect())
    assert kept == [1.0, 180.0]


def test_subsecond_ends_kept_as_one_minute(spark):
    start = T0.replace(microsecond=900000)
    row = list(_yellow_row(0, start=start))
    row[2] = dt.datetime(2024, 1, 1, 0, 1, 0, 100000)
    out = cleaning.clean_yellow(spark.createDataFrame([tuple(row)], YELLOW_DDL)).collect()
    assert [r.trip_duration_min for r in out] == [1.0]


def test_minute_boundary_loose_vs_strict(spark):
    row = list(_yellow_row(0))
    row[1], row[2] = T0 + dt.timedelta(seconds=59), T0 + dt.timedelta(seconds=61)
    raw = spark.createDataFrame([tuple(row)], YELLOW_DDL)
    assert cleaning.clean_yellow(raw).count() == 0
    assert [r.trip_duration_min for r in cleaning.explore_clean(raw).collect()] == [1]


def test_distance_bounds(spark):
    raw = spark.createDataFrame([_yellow_row(600, distance=d) for d in (0.0, 0.01, 99.99, 100.0)],
                                YELLOW_DDL)
    assert sorted(r.trip_distance for r in cleaning.clean_yellow(raw).collect()) == [0.01, 99.99]


def test_zone_filter_both_ends(spark):
    raw = spark.createDataFrame([_yellow_row(600, pu=4, do=1), _yellow_row(600, pu=1, do=4),
                                 _yellow_row(600, pu=263, do=12)], YELLOW_DDL)
    assert cleaning.clean_yellow(raw).count() == 1


def test_hvfhv_null_fee_gives_zero_fee_and_null_total(spark):
    ddl = ("hvfhs_license_num string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
           "PULocationID int, DOLocationID int, trip_miles double, base_passenger_fare double, "
           "tips double, tolls double, bcf double, sales_tax double, congestion_surcharge double, "
           "airport_fee double, cbd_congestion_fee double")
    end = T0 + dt.timedelta(seconds=600)
    raw = spark.createDataFrame([("HV0003", T0, end, 4, 4, 2.0, 10.0, 1.0, 0.0, 0.3, 0.8, None, 0.0, 0.0),
                                 ("HV0003", T0, end, 4, 4, 2.0, 10.0, 1.0, 0.0, 0.3, 0.8, 2.5, 0.0, 0.0)], ddl)
    rows = sorted(cleaning.clean_hvfhv(raw).collect(), key=lambda r: r.congestion_surcharge)
    assert rows[0].congestion_surcharge == 0.0 and rows[0].total_amount is None
    assert rows[1].total_amount == 14.6


def test_reject_reasons_partition_the_rows(spark):
    raw = spark.createDataFrame([_yellow_row(s) for s in (59, 60, 10800, 10801)]
                                + [_yellow_row(600, distance=0.0), _yellow_row(600, pu=1)], YELLOW_DDL)
    rep = {r.rule: r for r in cleaning.reject_reasons(raw, "yellow").collect()}
    firsts = sum(r.first_failed_rows for k, r in rep.items() if k not in ("all_rows", "kept"))
    assert rep["all_rows"].failed_rows == 6
    assert rep["kept"].failed_rows == cleaning.clean_yellow(raw).count() == 2
    assert firsts + rep["kept"].failed_rows == 6
