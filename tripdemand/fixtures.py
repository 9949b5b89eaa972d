"""Trip-shaped inputs derived from the driver's ``events`` table.

The driver ships no trip data, so the raw monthly trip files, the hourly
weather and the zone polygons are derived here, row by row, from ``events``
(rules in FIXTURES.md). The DuckDB oracle derives the very same rows with SQL
(``tripdemand.oracle.fixture_sql``), so both engines start from identical data.
This is the only module that knows the driver's tables.
"""

from __future__ import annotations

import datetime as _dt
import os
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdemand.operators.weather import weather_payload
from tripdemand.session import path_exists, scratch_path
from tripdemand.sources.trips import write_trip_files
from tripdemand.sources.zones import ZONE_IDS, ZONE_ROWS

# --- fixed values of the fixture ----------------------------------------------
FIXTURE_MONTHS = ("2024-01", "2024-02", "2024-03")
FIXTURE_START = _dt.datetime(2024, 1, 1)
# train < cut <= test
FIXTURE_CUT = "2024-03-01"
# report window of the daily trend: [start, end)
FIXTURE_TREND = ("2024-01-01", "2024-04-01")
YELLOW_CODES = {"click": 1, "view": 2, "error": 6}
FHVHV_CODES = {"purchase": "HV0003", "signup": "HV0005"}
# days between the pickups of one file month and the next
MONTH_SHIFT_DAYS = 28
# hours since FIXTURE_START of the busiest hour, and its zone's place in the zone list
HOT_HOUR, HOT_ZONE = 9 * 24 + 18, 30
# one GeoJSON feature per zone id plus this id, which has no metrics
GEO_EXTRA_ID = 1
# ------------------------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _zone(index: Column) -> Column:
    """Z[index] with 1-based index into the ascending zone list."""
    return F.element_at(F.array(*[F.lit(z) for z in ZONE_IDS]), index.cast("int"))


def _base(ev: DataFrame) -> DataFrame:
    eid, uid, value = F.col("event_id"), F.col("user_id"), F.col("value")
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    m = (eid % 3).cast("int")
    # of 32 events one keeps its hour and any zone, 12 share one hour and zone, 19 some of 4 hours and 3 zones
    share, n = eid % 32, F.floor(eid / 32)
    start_day = F.lit(FIXTURE_START.date().isoformat()).cast("date")
    own = F.datediff(F.to_date("ts"), start_day).cast("long") * 24 + F.hour("ts")
    busy = (n % 2 * 13 + 5) * 24 + 8 + F.floor(n / 2) % 2 * 10
    hours = F.when(share == 0, own).when(share <= 12, F.lit(HOT_HOUR)).otherwise(busy)
    pickup = F.timestamp_add("DAY", m * MONTH_SHIFT_DAYS, F.timestamp_add("HOUR", hours - own, F.col("ts")))
    zone = F.when(share == 0, (uid * 3 + eid) % 55 + 1).when(share <= 12, F.lit(HOT_ZONE)).otherwise(F.floor(n / 4) % 3 * 10 + 10)
    return ev.select(
        "event_id", "event_type", "value",
        k.alias("k"),
        F.element_at(F.array(*[F.lit(x) for x in FIXTURE_MONTHS]), m + 1).alias("file_month"),
        pickup.alias("pickup"),
        F.when(eid % 10 == 0, uid % 265 + 1)
         .otherwise(_zone(zone)).cast("int").alias("pu"),
        F.when(eid % 13 == 0, (uid * 5) % 265 + 1)
         .otherwise(_zone((uid + eid * 7) % 55 + 1)).cast("int").alias("do"),
    ).select(
        "*",
        F.timestamp_add("MILLISECOND", (F.col("k") * 179 - 835) * 1000 + F.col("event_id") % 1000,
                        F.col("pickup")).alias("dropoff"),
        (value - 1.0).alias("fare"),
        (value / 4.0 - 1.0).alias("distance"),
        F.when(F.col("k") % 7 == 0, F.lit(None).cast("double")).otherwise(value * 0.1).alias("tip"),
        ((F.col("event_id") % 4) * 1.25).alias("tolls"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("double")).otherwise(F.lit(2.5)).alias("congestion"),
        F.when(F.col("event_id") % 5 == 0, F.lit(None).cast("double")).otherwise(F.lit(0.75)).alias("cbd"),
    )


def raw_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw yellow trips (public column names) with ``file_month``."""
    b = _base(events(spark, sf_dir)).filter(F.col("event_type").isin(list(YELLOW_CODES)))
    vendor = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", 2).otherwise(6)
    return b.select(
        vendor.cast("int").alias("VendorID"),
        F.col("pickup").alias("tpep_pickup_datetime"),
        F.col("dropoff").alias("tpep_dropoff_datetime"),
        F.col("pu").alias("PULocationID"),
        F.col("do").alias("DOLocationID"),
        F.col("distance").alias("trip_distance"),
        F.col("fare").alias("fare_amount"),
        F.col("tip").alias("tip_amount"),
        F.col("tolls").alias("tolls_amount"),
        F.col("congestion").alias("congestion_surcharge"),
        F.lit(None).cast("double").alias("Airport_fee"),
        F.col("cbd").alias("cbd_congestion_fee"),
        (F.col("value") * 1.3 - 0.5).alias("total_amount"),
        "file_month",
    )


def raw_fhvhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw high-volume for-hire trips (public column names) with ``file_month``."""
    b = _base(events(spark, sf_dir)).filter(F.col("event_type").isin(list(FHVHV_CODES)))
    code = F.when(F.col("event_type") == "purchase", "HV0003").otherwise("HV0005")
    return b.select(
        code.alias("hvfhs_license_num"),
        F.col("pickup").alias("pickup_datetime"),
        F.col("dropoff").alias("dropoff_datetime"),
        F.col("pu").alias("PULocationID"),
        F.col("do").alias("DOLocationID"),
        F.col("distance").alias("trip_miles"),
        F.col("fare").alias("base_passenger_fare"),
        F.col("tip").alias("tips"),
        F.col("tolls").alias("tolls"),
        (F.col("value") * 0.03).alias("bcf"),
        (F.col("value") * 0.08).alias("sales_tax"),
        F.col("congestion").alias("congestion_surcharge"),
        F.when(F.col("event_id") % 6 == 0, F.lit(None).cast("double")).otherwise(F.lit(0.0)).alias("airport_fee"),
        F.col("cbd").alias("cbd_congestion_fee"),
        "file_month",
    )


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather for every hour in which a derived trip starts.

    Hour index ``i`` counts hours from 2024-01-01 00:00; hours with
    ``i % 17 == 0`` are left out so that joins meet missing weather. The
    values follow closed-form rules of ``i`` (FIXTURES.md). Output columns
    mirror the parsed weather payload: ``datetime`` plus the six measures.
    """
    # calendar arithmetic only: the hour index must not depend on the session zone
    start = F.lit(FIXTURE_START.isoformat(sep=" ")).cast("timestamp_ntz")
    start_day = F.lit(FIXTURE_START.date().isoformat()).cast("date")
    pickup = F.col("pickup")
    hours = (_base(events(spark, sf_dir))
             .select((F.datediff(F.to_date(pickup), start_day).cast("long") * 24
                      + F.hour(pickup)).alias("i"))
             .distinct()
             .filter(F.col("i") % 17 != 0))
    i = F.col("i")
    temperature = F.when(i % 101 == 0, F.lit(None).cast("double")).otherwise(
        (i % 37 - 8).cast("double") + (i % 10) / 10.0)
    return hours.select(
        F.timestamp_add("HOUR", i, start).alias("datetime"),
        temperature.alias("temperature"),
        (temperature - 2.0).alias("feels_like"),
        F.when(i % 97 == 0, F.lit(None).cast("double"))
         .when(i % 9 == 0, (i % 50) / 20.0).otherwise(F.lit(0.0)).alias("precipitation"),
        F.when(i % 23 == 0, (i % 7) / 2.0).otherwise(F.lit(0.0)).alias("snowfall"),
        ((i % 29) * 1.5).alias("windspeed"),
        F.when(i % 89 == 0, F.lit(None).cast("int")).otherwise(((i * 7) % 100).cast("int")).alias("weathercode"),
    )


def zone_feature_collection(spark: SparkSession) -> DataFrame:
    """A one-row GeoJSON FeatureCollection: one feature per zone, plus one extra id.

    Geometry is carried as an opaque empty polygon; only the ``LocationID``
    property matters to the join.
    """
    ids = [z[0] for z in ZONE_ROWS] + [GEO_EXTRA_ID]
    polygon = F.struct(F.lit("Polygon").alias("type"),
                       F.array().cast("array<array<array<double>>>").alias("coordinates"))
    feats = F.array(*[F.struct(F.lit("Feature").alias("type"),
                               F.struct(F.lit(i).cast("int").alias("LocationID")).alias("properties"),
                               polygon.alias("geometry")) for i in ids])
    return spark.range(1).select(F.lit("FeatureCollection").alias("type"), feats.alias("features"))


class Landing(NamedTuple):
    """Where the derived inputs were landed, in the shapes the pipeline reads."""
    trips: str            # <service>_tripdata_<YYYY-MM>.parquet folders
    weather_payload: str  # JSON lines, one weather payload per day


_LANDED: dict[tuple[str, str], Landing] = {}


def landed(spark: SparkSession, sf_dir: str) -> Landing:
    """Land the derived trips and weather once per session and return the paths.

    Trips go to one folder per service and month under the published file
    names, so queries read them through ``read_trips`` like real landed files
    (Parquet pushdown, file month from the path). Weather goes out as daily
    JSON payloads. Both are written under the session's checkpoint folder.
    """
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    hit = _LANDED.get(key)
    if hit is not None and path_exists(spark, hit.trips):
        return hit
    root = scratch_path(spark, "landing")
    parts = spark.sparkContext.defaultParallelism
    for service, derive in (("yellow", raw_yellow), ("fhvhv", raw_fhvhv)):
        rows = derive(spark, sf_dir).repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_trip_files(rows, root, service, FIXTURE_MONTHS)
        finally:
            rows.unpersist()
    payload_path = f"{root}/weather_payload"
    weather_payload(weather_hourly(spark, sf_dir)).write.mode("overwrite").text(payload_path)
    out = Landing(trips=root, weather_payload=payload_path)
    _LANDED[key] = out
    return out
