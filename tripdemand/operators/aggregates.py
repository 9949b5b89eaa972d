"""Warehouse aggregates: hourly demand and monthly zone demand.

Both aggregate the fact first, on the operator *code* and the time/zone keys,
and join the dimensions afterwards. Dimension attributes are functions of the
code (one dimension row per code), so the result equals join-then-aggregate,
but the shuffle carries partial aggregates of a few hundred thousand groups
instead of trips, and a hot key is absorbed by the map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdemand.functions import day_of_week_sun0, month_start, round_half_away
from tripdemand.operators.weather import weather_by_hour

_TRIP_MEANS = (
    ("fare_amount", "avg_fare"),
    ("total_amount", "avg_total"),
    ("trip_duration_min", "avg_duration_min"),
    ("trip_distance", "avg_distance"),
    ("tip_amount", "avg_tip"),
)


# what a group of trips is reduced to; adding up two groups' states gives the state of both
_STATE = ("_trips", *(f"{kind}_{c}" for c, _ in _TRIP_MEANS for kind in ("_sum", "_n")))
HOUR_KEYS = ("date", "hour", "PULocationID", "operator_code")
ZONE_KEYS = ("month", "PULocationID", "operator_code")


def trip_state(fact: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Trips, sums and non-null counts per (``keep``, date, hour, pickup zone, operator code).

    Hourly and zone demand both follow from it, and states of different files add up, so new
    files never need the old ones' trips again.
    """
    p = F.col("pickup_datetime")
    trips = fact.select(*keep, F.to_date(p).alias("date"), F.hour(p).alias("hour"), "PULocationID", "operator_code", *[c for c, _ in _TRIP_MEANS])
    return _reduced(trips, [*keep, *HOUR_KEYS])


def _reduced(trips: DataFrame, keys: Sequence[str]) -> DataFrame:
    sums = [x for c, _ in _TRIP_MEANS for x in (F.sum(F.col(c).cast("double")).alias(f"_sum_{c}"), F.count(c).alias(f"_n_{c}"))]
    return trips.groupBy(*keys).agg(F.count(F.lit(1)).alias("_trips"), *sums)


def _added(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    return state.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _STATE])


def _means(state: DataFrame) -> DataFrame:
    return state.select("*", *[(F.col(f"_sum_{c}") / F.col(f"_n_{c}")).alias(name) for c, name in _TRIP_MEANS])


def agg_hourly_demand(fact: DataFrame, operators: DataFrame, dim_weather: DataFrame) -> DataFrame:
    """Trips per (date, hour, weekday, pickup zone, operator) with means and weather.

    Unknown operator codes drop out (inner join); hours without weather
    get 0 for every weather value.
    """
    return _hourly(trip_state(fact), operators, dim_weather)


def hourly_of_state(state: DataFrame, operators: DataFrame, dim_weather: DataFrame) -> DataFrame:
    """The same from the states of any number of files."""
    return _hourly(_added(state, HOUR_KEYS), operators, dim_weather)


def _hourly(state: DataFrame, operators: DataFrame, dim_weather: DataFrame) -> DataFrame:
    # weekday is a function of the date: derived after the shuffle, not keyed on
    ops = F.broadcast(operators.select("operator_code", "operator_id", "taxi_type",
                                       "category", "operator_name"))
    joined = (_means(state).join(ops, "operator_code", "inner")
              .join(weather_by_hour(dim_weather), ["date", "hour"], "left"))
    w = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return joined.select(
        "date", "hour", day_of_week_sun0(F.col("date")).alias("day_of_week"),
        "PULocationID", "operator_id", "taxi_type", "category", "operator_name",
        (F.col("_trips") * F.coalesce(F.col("_w_rows"), F.lit(1))).alias("trip_count"),
        *[round_half_away(F.col(name), 2).alias(name) for _, name in _TRIP_MEANS],
        round_half_away(w("_w_temperature"), 1).alias("temperature"),
        round_half_away(w("_w_precipitation"), 2).alias("precipitation"),
        round_half_away(w("_w_windspeed"), 1).alias("windspeed"),
        F.coalesce(F.col("_w_is_rain"), F.lit(0)).cast("int").alias("is_rain"),
        F.coalesce(F.col("_w_is_snow"), F.lit(0)).cast("int").alias("is_snow"),
    )


def agg_zone_demand(fact: DataFrame, operators: DataFrame, locations: DataFrame) -> DataFrame:
    """Trips per (month, pickup zone, operator) with zone names and means."""
    trips = fact.withColumn("month", month_start(F.col("pickup_datetime")))
    return _zone(_reduced(trips, ZONE_KEYS), operators, locations)


def zone_of_state(state: DataFrame, operators: DataFrame, locations: DataFrame) -> DataFrame:
    """The same from the hourly states of any number of files."""
    return _zone(_added(state.withColumn("month", month_start(F.col("date"))), ZONE_KEYS), operators, locations)


def _zone(state: DataFrame, operators: DataFrame, locations: DataFrame) -> DataFrame:
    ops = F.broadcast(operators.select("operator_code", "taxi_type", "category", "operator_name"))
    locs = F.broadcast(locations.select(F.col("location_id").alias("PULocationID"),
                                        "zone_name", "borough"))
    joined = _means(state).join(ops, "operator_code", "inner").join(locs, "PULocationID", "inner")
    return joined.select(
        "month", "PULocationID", "zone_name", "borough", "taxi_type", "category", "operator_name",
        F.col("_trips").alias("trip_count"),
        *[round_half_away(F.col(c), 2).alias(c)
          for c in ("avg_fare", "avg_distance", "avg_duration_min", "avg_tip")],
    )
