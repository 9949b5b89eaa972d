"""DuckDB SQL that rebuilds the warehouse from the driver's ``events`` view.

This is the independent side of the parity check. It follows the textbook
form of each definition (join, then aggregate; one global ROW_NUMBER for trip
ids; DuckDB's own DATEDIFF and ROUND), not the Spark plans, so agreement
means the Spark re-plans are equivalent. Every query is ``WITH <ctes> SELECT``.
"""

from __future__ import annotations

from tripdemand.oracle.constants import OPERATORS, ZONES

FIXTURE_MONTHS = ("2024-01", "2024-02", "2024-03")
GEO_EXTRA_ID = 1


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_Z = "[" + ", ".join(str(z) for z, *_ in sorted(ZONES)) + "]"
_MONTHS = "[" + ", ".join(_sql_str(m) for m in FIXTURE_MONTHS) + "]"
_ZONE_VALUES = ",\n    ".join(
    f"({i}, {_sql_str(n)}, {_sql_str(b)}, {_sql_str(s)})" for i, n, b, s in ZONES)
_OP_VALUES = ",\n    ".join(
    f"({i}, {_sql_str(c)}, {_sql_str(n)}, {_sql_str(t)}, {_sql_str(g)})" for i, c, n, t, g in OPERATORS)

CTES = {}

CTES["fx_base"] = f"""
  SELECT event_id, event_type, value, user_id,
         CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k,
         CAST(event_id % 3 AS INTEGER) AS m,
         ts + to_days(CAST(event_id % 3 AS INTEGER) * 28)
            + to_hours(CASE WHEN event_id % 32 = 0 THEN 0
                            ELSE CASE WHEN event_id % 32 <= 12 THEN 234
                                      ELSE 24 * (5 + 13 * (event_id // 32 % 2)) + 8 + 10 * (event_id // 64 % 2) END
                                 - datediff('hour', TIMESTAMP '2024-01-01 00:00:00', ts) END) AS pickup
  FROM events"""

CTES["fx_rows"] = f"""
  SELECT event_id, event_type, value, k,
         {_MONTHS}[m + 1] AS file_month,
         pickup,
         pickup + to_milliseconds(CAST((k * 179 - 835) * 1000 + event_id % 1000 AS BIGINT)) AS dropoff,
         CAST(CASE WHEN event_id % 10 = 0 THEN user_id % 265 + 1
                   WHEN event_id % 32 = 0 THEN {_Z}[(3 * user_id + event_id) % 55 + 1]
                   WHEN event_id % 32 <= 12 THEN {_Z}[30]
                   ELSE {_Z}[10 + 10 * (event_id // 128 % 3)] END AS INTEGER) AS pu,
         CAST(CASE WHEN event_id % 13 = 0 THEN (5 * user_id) % 265 + 1
                   ELSE {_Z}[(user_id + 7 * event_id) % 55 + 1] END AS INTEGER) AS do_,
         value - 1.0::DOUBLE AS fare,
         value / 4.0::DOUBLE - 1.0::DOUBLE AS distance,
         CASE WHEN k % 7 = 0 THEN NULL ELSE value * 0.1::DOUBLE END AS tip,
         (event_id % 4) * 1.25::DOUBLE AS tolls,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE 2.5::DOUBLE END AS congestion,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE 0.75::DOUBLE END AS cbd
  FROM fx_base"""

CTES["raw_yellow"] = """
  SELECT CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 6 END AS INTEGER) AS VendorID,
         pickup AS tpep_pickup_datetime, dropoff AS tpep_dropoff_datetime,
         pu AS PULocationID, do_ AS DOLocationID,
         distance AS trip_distance, fare AS fare_amount, tip AS tip_amount, tolls AS tolls_amount,
         congestion AS congestion_surcharge, CAST(NULL AS DOUBLE) AS Airport_fee,
         cbd AS cbd_congestion_fee, value * 1.3::DOUBLE - 0.5::DOUBLE AS total_amount,
         file_month
  FROM fx_rows WHERE event_type IN ('click', 'view', 'error')"""

CTES["raw_fhvhv"] = """
  SELECT CASE event_type WHEN 'purchase' THEN 'HV0003' ELSE 'HV0005' END AS hvfhs_license_num,
         pickup AS pickup_datetime, dropoff AS dropoff_datetime,
         pu AS PULocationID, do_ AS DOLocationID,
         distance AS trip_miles, fare AS base_passenger_fare, tip AS tips, tolls AS tolls,
         value * 0.03::DOUBLE AS bcf, value * 0.08::DOUBLE AS sales_tax,
         congestion AS congestion_surcharge,
         CASE WHEN event_id % 6 = 0 THEN NULL ELSE 0.0::DOUBLE END AS airport_fee,
         cbd AS cbd_congestion_fee,
         file_month
  FROM fx_rows WHERE event_type IN ('purchase', 'signup')"""

CTES["weather_hourly"] = """
  SELECT TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(i AS BIGINT)) AS datetime,
         CASE WHEN i % 101 = 0 THEN NULL
              ELSE CAST(i % 37 - 8 AS DOUBLE) + (i % 10) / 10.0::DOUBLE END AS temperature,
         CASE WHEN i % 101 = 0 THEN NULL
              ELSE CAST(i % 37 - 8 AS DOUBLE) + (i % 10) / 10.0::DOUBLE - 2.0::DOUBLE END AS feels_like,
         CASE WHEN i % 97 = 0 THEN NULL WHEN i % 9 = 0 THEN (i % 50) / 20.0::DOUBLE
              ELSE 0.0::DOUBLE END AS precipitation,
         CASE WHEN i % 23 = 0 THEN (i % 7) / 2.0::DOUBLE ELSE 0.0::DOUBLE END AS snowfall,
         (i % 29) * 1.5::DOUBLE AS windspeed,
         CASE WHEN i % 89 = 0 THEN NULL ELSE CAST((7 * i) % 100 AS INTEGER) END AS weathercode
  FROM (SELECT DISTINCT datediff('hour', TIMESTAMP '2024-01-01 00:00:00', pickup) AS i FROM fx_rows)
  WHERE i % 17 <> 0"""

CTES["dim_weather"] = """
  SELECT CAST(datetime AS DATE) AS date, CAST(hour(datetime) AS INTEGER) AS hour,
         COALESCE(temperature, 0.0::DOUBLE) AS temperature,
         COALESCE(feels_like, 0.0::DOUBLE) AS feels_like,
         COALESCE(precipitation, 0.0::DOUBLE) AS precipitation,
         COALESCE(snowfall, 0.0::DOUBLE) AS snowfall,
         COALESCE(windspeed, 0.0::DOUBLE) AS windspeed,
         CAST(COALESCE(weathercode, 0) AS INTEGER) AS weathercode,
         CAST(COALESCE(precipitation > 0.1::DOUBLE, false) AS INTEGER) AS is_rain,
         CAST(COALESCE(snowfall > 0.0::DOUBLE, false) AS INTEGER) AS is_snow
  FROM weather_hourly"""

CTES["dim_location"] = f"""
  SELECT * FROM (VALUES
    {_ZONE_VALUES}
  ) t(location_id, zone_name, borough, service_zone)"""

CTES["dim_operator"] = f"""
  SELECT * FROM (VALUES
    {_OP_VALUES}
  ) t(operator_id, operator_code, operator_name, taxi_type, category)"""

# Where each column of a clean trip comes from, by service.
_SOURCES = {
    "yellow": {
        "operator_code": "VendorID::VARCHAR", "pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime",
        "trip_distance": "trip_distance", "fare_amount": "fare_amount", "tip_amount": "tip_amount", "tolls_amount": "tolls_amount",
        "airport_fee": "Airport_fee", "total_amount": "total_amount"},
    "fhvhv": {
        "operator_code": "hvfhs_license_num", "pickup_datetime": "pickup_datetime", "dropoff_datetime": "dropoff_datetime",
        "trip_distance": "trip_miles", "fare_amount": "base_passenger_fare", "tip_amount": "tips", "tolls_amount": "tolls",
        "airport_fee": "airport_fee",
        # null parts make the total null, so it is formed before fees are filled
        "total_amount": "ROUND(base_passenger_fare + tolls + bcf + sales_tax + congestion_surcharge + airport_fee + tips + cbd_congestion_fee, 2)"},
}
# What a trip must satisfy; a null fails.
RULES = {
    "zone": "list_contains({zones}, PULocationID) AND list_contains({zones}, DOLocationID)",
    "fare": "fare_amount > 0",
    "distance": "trip_distance > 0 AND trip_distance < 100",
    "order": "dropoff_datetime > pickup_datetime",
    "duration": "seconds >= 60 AND seconds <= 10800",
}
_FEES = ("congestion_surcharge", "airport_fee", "cbd_congestion_fee")
# columns of the clean zone, in order
_CLEAN = (
    "operator_code", "PULocationID", "DOLocationID", "pickup_datetime", "dropoff_datetime", "trip_duration_min", "trip_distance",
    "fare_amount", "tip_amount", "tolls_amount", *_FEES, "total_amount", "service", "file_month")


def _clean_cte(service: str) -> str:
    source = {c: c for c in ("PULocationID", "DOLocationID", "congestion_surcharge", "cbd_congestion_fee", "file_month")} | _SOURCES[service]
    named = ", ".join(f"{expr} AS {name}" for name, expr in source.items())
    shown = {"trip_duration_min": "ROUND(seconds / 60.0::DOUBLE, 2)", "service": f"'{service}'"} | {f: f"COALESCE({f}, 0.0::DOUBLE)" for f in _FEES}
    out = ", ".join(f"{shown[c]} AS {c}" if c in shown else c for c in _CLEAN)
    kept = " AND ".join(f"({rule.format(zones=_Z)})" for rule in RULES.values())
    return f"""
  SELECT {out}
  FROM (SELECT *, datediff('second', pickup_datetime, dropoff_datetime) AS seconds
        FROM (SELECT {named} FROM raw_{service}))
  WHERE {kept}"""


for _service in _SOURCES:
    CTES[f"clean_{_service}"] = _clean_cte(_service)

CTES["clean_all"] = """
  SELECT * FROM clean_yellow UNION ALL SELECT * FROM clean_fhvhv"""

_ORDER = ", ".join(
    ["CASE service WHEN 'yellow' THEN 0 ELSE 1 END", "file_month"]
    + [f"{c} ASC NULLS FIRST" for c in (
        "operator_code", "PULocationID", "DOLocationID", "pickup_datetime", "dropoff_datetime",
        "trip_duration_min", "trip_distance", "fare_amount", "tip_amount", "tolls_amount",
        "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "total_amount")])

CTES["fact_trips"] = f"""
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY {_ORDER}) AS BIGINT) AS trip_id,
         operator_code, CAST(PULocationID AS INTEGER) AS PULocationID,
         CAST(DOLocationID AS INTEGER) AS DOLocationID,
         pickup_datetime, dropoff_datetime,
         CAST(trip_duration_min AS FLOAT) AS trip_duration_min,
         CAST(trip_distance AS FLOAT) AS trip_distance,
         CAST(fare_amount AS FLOAT) AS fare_amount,
         CAST(tip_amount AS FLOAT) AS tip_amount,
         CAST(tolls_amount AS FLOAT) AS tolls_amount,
         CAST(congestion_surcharge AS FLOAT) AS congestion_surcharge,
         CAST(airport_fee AS FLOAT) AS airport_fee,
         CAST(cbd_congestion_fee AS FLOAT) AS cbd_congestion_fee,
         CAST(total_amount AS FLOAT) AS total_amount
  FROM clean_all"""

# Sums and counts of the trips per key; dimensions are attached to the groups afterwards.
_MEANS = {"fare_amount": "avg_fare", "total_amount": "avg_total", "trip_duration_min": "avg_duration_min", "trip_distance": "avg_distance", "tip_amount": "avg_tip"}


def _grouped(keys: str, measures: tuple[str, ...]) -> str:
    parts = ", ".join(f"sum({m}::DOUBLE) AS s_{m}, count({m}) AS n_{m}" for m in measures)
    return f"SELECT {keys}, operator_code, PULocationID, count(*) AS trip_count, {parts} FROM fact_trips GROUP BY ALL"


def _averages(measures: tuple[str, ...]) -> str:
    return ", ".join(f"ROUND(s_{m} / n_{m}, 2) AS {_MEANS[m]}" for m in measures)


_HOURLY = tuple(_MEANS)
_MONTHLY = ("fare_amount", "trip_distance", "trip_duration_min", "tip_amount")

CTES["weather_of_hour"] = """
  SELECT date, hour, avg(temperature) AS t, avg(precipitation) AS p, avg(windspeed) AS v, max(is_rain) AS rain, max(is_snow) AS snow
  FROM dim_weather GROUP BY date, hour"""

CTES["agg_hourly_demand"] = f"""
  SELECT g.date, g.hour, dayofweek(g.date)::INTEGER AS day_of_week, g.PULocationID,
         operator_id, taxi_type, category, operator_name, trip_count, {_averages(_HOURLY)},
         ROUND(ifnull(t, 0), 1) AS temperature, ROUND(ifnull(p, 0), 2) AS precipitation, ROUND(ifnull(v, 0), 1) AS windspeed,
         ifnull(rain, 0)::INTEGER AS is_rain, ifnull(snow, 0)::INTEGER AS is_snow
  FROM ({_grouped("pickup_datetime::DATE AS date, hour(pickup_datetime)::INTEGER AS hour", _HOURLY)}) g
  NATURAL JOIN dim_operator LEFT JOIN weather_of_hour w USING (date, hour)"""

CTES["agg_zone_demand"] = f"""
  SELECT month, PULocationID, zone_name, borough, taxi_type, category, operator_name, trip_count, {_averages(_MONTHLY)}
  FROM ({_grouped("date_trunc('month', pickup_datetime) AS month", _MONTHLY)}) g
  NATURAL JOIN dim_operator JOIN dim_location ON location_id = PULocationID"""

CTES["geo_features"] = f"""
  SELECT location_id AS LocationID, '{{"type":"Polygon","coordinates":[]}}' AS geometry
  FROM dim_location
  UNION ALL SELECT {GEO_EXTRA_ID}, '{{"type":"Polygon","coordinates":[]}}'"""


def with_ctes(select: str, extra: dict[str, str] | None = None) -> str:
    """Full query: every fixture CTE (DuckDB drops the unused ones), then ``select``."""
    ctes = dict(CTES)
    ctes.update(extra or {})
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in ctes.items())
    return f"WITH {body}\n{select}"
