"""Registered queries: Spark side and (where SQL can express it) the oracle.

Each query takes ``(spark, sf_dir)``, derives its inputs from the driver's
tables through ``tripdemand.fixtures`` and returns a lazy DataFrame (a few
run a write or a model fit first). The oracle SQL for the same key runs in
DuckDB over the same tables (see ``tripdemand.oracle.fixture_sql``).
"""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdemand import fixtures as fx
from tripdemand.operators import aggregates, cleaning, ml, quality, reports, warehouse
from tripdemand.operators import weather as wx
from tripdemand.oracle.fixture_sql import with_ctes
from tripdemand.plans import model as model_job
from tripdemand.plans import warehouse as job
from tripdemand.plans.reports import report_bundle
from tripdemand.session import scratch_path
from tripdemand.sources import trips as src
from tripdemand.sources import zones
from tripdemand.streaming.landing import clean_new_files, read_incremental_clean

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, extra: dict[str, str] | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_ctes(sql, extra)
        return fn
    return deco


# --- SQL helpers for the oracle (same arithmetic as tripdemand.functions) -----

def emean(x: str, places: int) -> str:
    s = 10 ** places
    return f"(SUM(CAST(ROUND(({x}) * {s}.0) AS BIGINT)) / (COUNT({x}) * {s}))"


def ssum(x: str, places: int) -> str:
    s = 10 ** places
    return f"(SUM(CAST(ROUND(({x}) * {s}.0) AS BIGINT)) / {s}.0)"


def reven(x: str, places: int) -> str:
    s = 10 ** places
    return f"(round_even(({x}) * {s}.0, 0) / {s}.0)"


# --- building blocks (lazy DataFrames over the landed fixture) ----------------
# Base plans are built once per session and shared by the queries above them,
# the way an application builds its DataFrames once. Only lazy plans are
# shared: each query still executes its whole plan over the landed files or the
# warehouse built from them once a session.

_PLANS: dict[tuple, DataFrame] = {}


def _per_session(fn):
    @functools.wraps(fn)
    def wrapper(spark, sf_dir, *args, **kwargs):
        key = (fn.__name__, spark.sparkContext.applicationId, os.path.abspath(sf_dir), args,
               tuple(sorted(kwargs.items())))
        df = _PLANS.get(key)
        if df is None:
            df = _PLANS[key] = fn(spark, sf_dir, *args, **kwargs)
        return df
    return wrapper


@_per_session
def raw_yellow_df(spark, sf_dir):
    return src.read_trips(spark, fx.landed(spark, sf_dir).trips, "yellow", fx.FIXTURE_MONTHS)


@_per_session
def raw_fhvhv_df(spark, sf_dir):
    return src.read_trips(spark, fx.landed(spark, sf_dir).trips, "fhvhv", fx.FIXTURE_MONTHS)


@_per_session
def weather_hourly_df(spark, sf_dir):
    payloads = wx.read_payloads(spark, fx.landed(spark, sf_dir).weather_payload)
    return wx.explode_weather(payloads, "value")


@_per_session
def clean_yellow_df(spark, sf_dir):
    return cleaning.clean_yellow(raw_yellow_df(spark, sf_dir))


@_per_session
def clean_fhvhv_df(spark, sf_dir):
    return cleaning.clean_hvfhv(raw_fhvhv_df(spark, sf_dir))


@_per_session
def clean_all_df(spark, sf_dir):
    return cleaning.union_clean(clean_yellow_df(spark, sf_dir), clean_fhvhv_df(spark, sf_dir))


_WAREHOUSES: dict[tuple, str] = {}


def warehouse_root(spark, sf_dir):
    """The session's warehouse, built once from the landed files; facts and reports read it."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _WAREHOUSES:
        root = scratch_path(spark, "warehouse")
        job.build_warehouse(spark, fx.landed(spark, sf_dir).trips, root, fx.FIXTURE_MONTHS, weather_hourly_df(spark, sf_dir))
        _WAREHOUSES[key] = root
    return _WAREHOUSES[key]


@_per_session
def fact_df(spark, sf_dir):
    """The loaded fact with its ids and file months."""
    return job.read_table(spark, warehouse_root(spark, sf_dir), "fact_trips", folder=True)


@_per_session
def fact_rows_df(spark, sf_dir):
    """Rows of the loaded fact without ids, which follow the place in a file and differ between loads."""
    return fact_df(spark, sf_dir).drop("trip_id", "file_month")


@_per_session
def dim_weather_df(spark, sf_dir):
    return job.read_table(spark, warehouse_root(spark, sf_dir), "dim_weather")


@_per_session
def agg_hourly_df(spark, sf_dir):
    return job.read_table(spark, warehouse_root(spark, sf_dir), "agg_hourly_demand")


@_per_session
def agg_zone_df(spark, sf_dir):
    return job.read_table(spark, warehouse_root(spark, sf_dir), "agg_zone_demand")


@_per_session
def zone_profile_df(spark, sf_dir, month=None, category=reports.ALL_CATEGORIES):
    return reports.zone_profile(agg_zone_df(spark, sf_dir), month, category)


@_per_session
def hourly_profile_df(spark, sf_dir, month=None, category=reports.ALL_CATEGORIES):
    return reports.hourly_profile(agg_hourly_df(spark, sf_dir), month, category)


@_per_session
def features_df(spark, sf_dir):
    return ml.build_features(agg_hourly_df(spark, sf_dir))


def split_df(spark, sf_dir):
    return ml.time_split(features_df(spark, sf_dir), fx.FIXTURE_CUT)


def baseline_df(spark, sf_dir):
    train, test = split_df(spark, sf_dir)
    return ml.baseline_predictions(train, test)


def _fit(spark, sf_dir):
    train, test = split_df(spark, sf_dir)
    return ml.fit_demand(train), train, test


_MODELS: dict[tuple, object] = {}


def _session_model(spark, sf_dir):
    """The session's fitted model (all 300 trees), shared by the model keys.

    An application fits once and then scores and reports many times.
    """
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _MODELS:
        _MODELS[key] = _fit(spark, sf_dir)[0]
    train, test = split_df(spark, sf_dir)
    return _MODELS[key], train, test


# --- oracle CTEs above the warehouse ------------------------------------------

_PROFILE_MEANS = ", ".join(f"ROUND({emean(c, 2)}, 2) AS {c}"
                           for c in ("avg_fare", "avg_tip", "avg_distance", "avg_duration_min"))

ZP = {"zone_profile": f"""
  SELECT PULocationID, zone_name, category, operator_name,
         CAST(SUM(trip_count) AS BIGINT) AS trip_count, {_PROFILE_MEANS}
  FROM agg_zone_demand GROUP BY 1, 2, 3, 4"""}

HP = {"hourly_profile": f"""
  SELECT hour, day_of_week, category, operator_name,
         CAST(SUM(trip_count) AS BIGINT) AS trip_count, {_PROFILE_MEANS}
  FROM agg_hourly_demand GROUP BY 1, 2, 3, 4"""}

_FEATURES_SQL = """
  SELECT a.*,
         CAST(month(date) AS INTEGER) AS month,
         CAST(day_of_week IN (0, 6) AS INTEGER) AS is_weekend,
         sin(2 * pi() * hour / 24) AS hour_sin, cos(2 * pi() * hour / 24) AS hour_cos,
         sin(2 * pi() * day_of_week / 7) AS dow_sin, cos(2 * pi() * day_of_week / 7) AS dow_cos,
         CAST(category = 'Modern' AS INTEGER) AS category_enc,
         CASE operator_name WHEN 'Creative Mobile Tech' THEN 0 WHEN 'VeriFone' THEN 1
              WHEN 'Uber' THEN 2 WHEN 'Lyft' THEN 3 ELSE -1 END AS operator_enc
  FROM agg_hourly_demand a"""
FEAT = {"features": _FEATURES_SQL}

_BASELINE_SQL = {
    "features": _FEATURES_SQL,
    "train": f"SELECT * FROM features WHERE date < DATE '{fx.FIXTURE_CUT}'",
    "test": f"SELECT * FROM features WHERE date >= DATE '{fx.FIXTURE_CUT}'",
    "hist": """SELECT PULocationID, hour, operator_name, AVG(CAST(trip_count AS DOUBLE)) AS h
               FROM train GROUP BY 1, 2, 3""",
    "baseline": """
  SELECT t.date, t.hour, t.day_of_week, t.PULocationID, t.category, t.operator_name, t.trip_count,
         GREATEST(0.0::DOUBLE, COALESCE(h.h, (SELECT AVG(CAST(trip_count AS DOUBLE)) FROM train)))
           AS prediction_clipped
  FROM test t LEFT JOIN hist h USING (PULocationID, hour, operator_name)""",
    "baseline_pred": f"""
  SELECT *, {reven('prediction_clipped', 1)} AS predicted FROM baseline""",
}


# --- 2.1 sources and sinks -------------------------------------------------------

@register("read_trips", "SELECT * FROM raw_yellow")
def q_read_trips(spark, sf_dir):
    return raw_yellow_df(spark, sf_dir)


@register("read_trips_hvfhv", "SELECT * FROM raw_fhvhv")
def q_read_trips_hvfhv(spark, sf_dir):
    return raw_fhvhv_df(spark, sf_dir)


# one month more than was landed
_REQUESTED_MONTHS = fx.FIXTURE_MONTHS + ("2024-04",)


@register("missing_months", f"""
  SELECT s.service, m.file_month
  FROM (VALUES ('yellow'), ('fhvhv')) s(service),
       (VALUES {", ".join(f"('{m}')" for m in _REQUESTED_MONTHS)}) m(file_month)
  WHERE NOT EXISTS (
    SELECT 1 FROM (SELECT 'yellow' AS service, file_month FROM raw_yellow
                   UNION ALL SELECT 'fhvhv', file_month FROM raw_fhvhv) l
    WHERE l.service = s.service AND l.file_month = m.file_month)""")
def q_missing_months(spark, sf_dir):
    requested = [(s, m) for s in src.SERVICES for m in _REQUESTED_MONTHS]
    return src.missing_months(spark, fx.landed(spark, sf_dir).trips, requested)


@register("clean_roundtrip", "SELECT * FROM clean_all")
def q_clean_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "clean")
    src.write_clean(clean_all_df(spark, sf_dir), path)
    back = src.read_clean(spark, path)
    return back.withColumn("file_month", F.col("file_month").cast("string"))


@register("clean_incremental", "SELECT * FROM clean_all")
def q_clean_incremental(spark, sf_dir):
    root = fx.landed(spark, sf_dir).trips
    out = scratch_path(spark, "clean-stream")
    for service in src.SERVICES:
        clean_new_files(spark, root, service, out, scratch_path(spark, f"clean-stream-ckpt-{service}"))
    return read_incremental_clean(spark, out)


@register("weather_explode", "SELECT * FROM weather_hourly")
def q_weather_explode(spark, sf_dir):
    return weather_hourly_df(spark, sf_dir)


# --- 2.2 projections and filters ---------------------------------------------------

@register("clean_yellow", "SELECT * FROM clean_yellow")
def q_clean_yellow(spark, sf_dir):
    return clean_yellow_df(spark, sf_dir)


@register("clean_hvfhv", "SELECT * FROM clean_fhvhv")
def q_clean_hvfhv(spark, sf_dir):
    return clean_fhvhv_df(spark, sf_dir)


def _zone_semi_sql(service):
    return f"SELECT * FROM raw_{service} WHERE PULocationID IN (SELECT location_id FROM dim_location) AND DOLocationID IN (SELECT location_id FROM dim_location)"


@register("zone_semi", _zone_semi_sql("yellow"))
def q_zone_semi(spark, sf_dir):
    return cleaning.zone_semi(raw_yellow_df(spark, sf_dir), zones.builtin_dim_location(spark))


@register("zone_semi_hvfhv", _zone_semi_sql("fhvhv"))
def q_zone_semi_hvfhv(spark, sf_dir):
    return cleaning.zone_semi(raw_fhvhv_df(spark, sf_dir), zones.builtin_dim_location(spark))


# what the exploratory cleaner asks of a trip: measures above zero, ids that are there, and minutes in a range
_EXPLORE_ABOVE_ZERO = ("fare_amount", "trip_distance", "total_amount")
_EXPLORE_PRESENT = ("PULocationID", "DOLocationID")
_EXPLORE_MINUTES = (1, 180)


def _explore_sql():
    pickup, dropoff = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    asked = [f"{c} > 0" for c in _EXPLORE_ABOVE_ZERO] + [f"{c} IS NOT NULL" for c in _EXPLORE_PRESENT] + ["m >= {} AND m <= {}".format(*_EXPLORE_MINUTES)]
    return (f"SELECT t.* EXCLUDE (m), m AS trip_duration_min, CAST(hour({pickup}) AS INTEGER) AS hour, dayname({pickup}) AS day_of_week "
            f"FROM (SELECT *, datediff('minute', {pickup}, {dropoff}) AS m FROM raw_yellow) t WHERE {' AND '.join(asked)}")


_EXPLORE_SQL = _explore_sql()


@register("explore_clean", _EXPLORE_SQL)
def q_explore_clean(spark, sf_dir):
    return cleaning.explore_clean(raw_yellow_df(spark, sf_dir))


_RAW_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in (
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID",
    "trip_distance", "fare_amount", "tip_amount", "tolls_amount", "congestion_surcharge",
    "Airport_fee", "cbd_congestion_fee", "total_amount", "file_month"))


@register("anomaly_fare", f"SELECT * FROM raw_yellow WHERE fare_amount <= 0 ORDER BY {_RAW_ORDER} LIMIT 10")
def q_anomaly_fare(spark, sf_dir):
    return cleaning.negative_fares(raw_yellow_df(spark, sf_dir), 10)


@register("anomaly_distance",
          f"SELECT * FROM raw_yellow WHERE trip_distance <= 0 ORDER BY {_RAW_ORDER} LIMIT 10")
def q_anomaly_distance(spark, sf_dir):
    return cleaning.invalid_distances(raw_yellow_df(spark, sf_dir), 10)


def _reject_sql(service, raw, p, d, fare, dist):
    zin = "(SELECT location_id FROM dim_location)"
    rules = [("pickup_zone", f"PULocationID IN {zin}"), ("dropoff_zone", f"DOLocationID IN {zin}"),
             ("fare_positive", f"{fare} > 0"), ("distance_positive", f"{dist} > 0"),
             ("distance_below_max", f"{dist} < 100"), ("dropoff_after_pickup", f"{d} > {p}"),
             ("duration_in_range", f"datediff('second', {p}, {d}) BETWEEN 60 AND 10800")]
    flags = ", ".join(f"NOT COALESCE({cond}, false) AS f{i}" for i, (_, cond) in enumerate(rules))
    n = len(rules)
    firsts = []
    for i, (name, _) in enumerate(rules):
        prior = " AND ".join([f"NOT f{j}" for j in range(i)] + [f"f{i}"])
        firsts.append(f"SELECT '{service}' AS service, {i + 1} AS rule_order, '{name}' AS rule, "
                      f"COUNT(*) FILTER (WHERE f{i}) AS failed_rows, "
                      f"COUNT(*) FILTER (WHERE {prior}) AS first_failed_rows FROM flags_{service}")
    kept = " AND ".join(f"NOT f{j}" for j in range(n))
    firsts.append(f"SELECT '{service}', 0, 'all_rows', COUNT(*), COUNT(*) FROM flags_{service}")
    firsts.append(f"SELECT '{service}', {n + 1}, 'kept', COUNT(*) FILTER (WHERE {kept}), "
                  f"COUNT(*) FILTER (WHERE {kept}) FROM flags_{service}")
    cte = {f"flags_{service}": f"SELECT {flags} FROM {raw}"}
    return cte, " UNION ALL ".join(firsts)


_RY_CTE, _RY_SQL = _reject_sql("yellow", "raw_yellow", "tpep_pickup_datetime", "tpep_dropoff_datetime",
                               "fare_amount", "trip_distance")
_RF_CTE, _RF_SQL = _reject_sql("fhvhv", "raw_fhvhv", "pickup_datetime", "dropoff_datetime",
                               "base_passenger_fare", "trip_miles")


@register("reject_reasons", f"SELECT service, rule_order, rule, CAST(failed_rows AS BIGINT) AS failed_rows, "
          f"CAST(first_failed_rows AS BIGINT) AS first_failed_rows FROM ({_RY_SQL} UNION ALL {_RF_SQL})",
          {**_RY_CTE, **_RF_CTE})
def q_reject_reasons(spark, sf_dir):
    return (cleaning.reject_reasons(raw_yellow_df(spark, sf_dir), "yellow")
            .unionByName(cleaning.reject_reasons(raw_fhvhv_df(spark, sf_dir), "fhvhv")))


@register("hourly_profile_month", f"""
  SELECT hour, day_of_week, category, operator_name,
         CAST(SUM(trip_count) AS BIGINT) AS trip_count, {_PROFILE_MEANS}
  FROM agg_hourly_demand
  WHERE date >= DATE '2024-02-01' AND date < DATE '2024-02-01' + INTERVAL 1 MONTH
  GROUP BY 1, 2, 3, 4""")
def q_hourly_profile_month(spark, sf_dir):
    return hourly_profile_df(spark, sf_dir, month="2024-02-01")


@register("zone_profile_month", f"""
  SELECT PULocationID, zone_name, category, operator_name,
         CAST(SUM(trip_count) AS BIGINT) AS trip_count, {_PROFILE_MEANS}
  FROM agg_zone_demand WHERE month = TIMESTAMP '2024-02-01 00:00:00' GROUP BY 1, 2, 3, 4""")
def q_zone_profile_month(spark, sf_dir):
    return zone_profile_df(spark, sf_dir, month="2024-02-01")


@register("zone_profile_category", f"""
  SELECT PULocationID, zone_name, category, operator_name,
         CAST(SUM(trip_count) AS BIGINT) AS trip_count, {_PROFILE_MEANS}
  FROM agg_zone_demand WHERE category = 'Modern' GROUP BY 1, 2, 3, 4""")
def q_zone_profile_category(spark, sf_dir):
    return zone_profile_df(spark, sf_dir, category="Modern")


# --- 2.3 joins ----------------------------------------------------------------------

@register("fact_operator_join", """
  SELECT f.* EXCLUDE (trip_id), o.operator_id, o.operator_name, o.taxi_type, o.category
  FROM fact_trips f JOIN dim_operator o USING (operator_code)""")
def q_fact_operator_join(spark, sf_dir):
    return warehouse.fact_operator_join(fact_rows_df(spark, sf_dir), zones.dim_operator(spark))


@register("fact_weather_join", """
  SELECT f.operator_code, f.PULocationID, f.pickup_datetime, CAST(f.pickup_datetime AS DATE) AS date,
         CAST(hour(f.pickup_datetime) AS INTEGER) AS hour,
         COALESCE(w.temperature, 0.0::DOUBLE) AS temperature,
         COALESCE(w.precipitation, 0.0::DOUBLE) AS precipitation,
         COALESCE(w.windspeed, 0.0::DOUBLE) AS windspeed,
         COALESCE(w.is_rain, 0) AS is_rain, COALESCE(w.is_snow, 0) AS is_snow
  FROM fact_trips f LEFT JOIN dim_weather w
    ON CAST(f.pickup_datetime AS DATE) = w.date AND hour(f.pickup_datetime) = w.hour""")
def q_fact_weather_join(spark, sf_dir):
    fact = fact_rows_df(spark, sf_dir)
    p = F.col("pickup_datetime")
    trip = ("operator_code", "PULocationID", "pickup_datetime")
    keyed = fact.select(*trip, F.to_date(p).alias("date"), F.hour(p).alias("hour"))
    w = dim_weather_df(spark, sf_dir).select("date", "hour", "temperature", "precipitation",
                                             "windspeed", "is_rain", "is_snow")
    joined = keyed.join(w, ["date", "hour"], "left")
    return joined.select(*trip, "date", "hour",
                         *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("temperature", "precipitation", "windspeed")],
                         *[F.coalesce(c, F.lit(0)).alias(c) for c in ("is_rain", "is_snow")])


@register("demand_weather_defaults", """
  SELECT a.* EXCLUDE (temperature, precipitation, windspeed, is_rain, is_snow),
         COALESCE(w.temperature, 15.0::DOUBLE) AS temperature,
         COALESCE(w.precipitation, 0.0::DOUBLE) AS precipitation,
         COALESCE(w.windspeed, 10.0::DOUBLE) AS windspeed,
         COALESCE(w.is_rain, 0) AS is_rain, COALESCE(w.is_snow, 0) AS is_snow
  FROM agg_hourly_demand a LEFT JOIN dim_weather w USING (date, hour)""")
def q_demand_weather_defaults(spark, sf_dir):
    return wx.demand_weather_defaults(agg_hourly_df(spark, sf_dir), dim_weather_df(spark, sf_dir))


@register("zone_features", f"""
  SELECT g.LocationID, g.geometry, m.zone_name, m.trip_count, m.avg_fare, m.avg_distance
  FROM geo_features g LEFT JOIN (
    SELECT PULocationID, zone_name, CAST(SUM(trip_count) AS BIGINT) AS trip_count,
           {emean('avg_fare', 2)} AS avg_fare, {emean('avg_distance', 2)} AS avg_distance
    FROM zone_profile WHERE category = 'Modern' GROUP BY 1, 2) m
  ON g.LocationID = m.PULocationID""", ZP)
def q_zone_features(spark, sf_dir):
    metrics = reports.zone_map(zone_profile_df(spark, sf_dir), "Modern")
    return reports.zone_features(fx.zone_feature_collection(spark), metrics)


@register("orphan_operators", """
  SELECT operator_code, COUNT(*) AS trip_count FROM fact_trips
  WHERE operator_code NOT IN (SELECT operator_code FROM dim_operator) GROUP BY 1""")
def q_orphan_operators(spark, sf_dir):
    return warehouse.orphan_operators(fact_rows_df(spark, sf_dir), zones.dim_operator(spark))


@register("scenario_grid", f"""
  SELECT s.date, s.PULocationID, s.category, s.operator_name,
         CAST(h.hour AS INTEGER) AS hour, CAST(dayofweek(s.date) AS INTEGER) AS day_of_week,
         CAST(month(s.date) AS INTEGER) AS month,
         CAST(dayofweek(s.date) IN (0, 6) AS INTEGER) AS is_weekend,
         CAST(s.category = 'Modern' AS INTEGER) AS category_enc,
         CASE s.operator_name WHEN 'Creative Mobile Tech' THEN 0 WHEN 'VeriFone' THEN 1
              WHEN 'Uber' THEN 2 WHEN 'Lyft' THEN 3 ELSE -1 END AS operator_enc,
         sin(2 * pi() * h.hour / 24) AS hour_sin, cos(2 * pi() * h.hour / 24) AS hour_cos,
         sin(2 * pi() * dayofweek(s.date) / 7) AS dow_sin, cos(2 * pi() * dayofweek(s.date) / 7) AS dow_cos,
         s.temperature, s.precipitation, s.windspeed,
         CAST(s.precipitation > 0.1::DOUBLE AS INTEGER) AS is_rain,
         CAST(s.temperature <= 2.0::DOUBLE AND s.precipitation > 0.0::DOUBLE AS INTEGER) AS is_snow
  FROM scenarios s CROSS JOIN (SELECT CAST(range AS INTEGER) AS hour FROM range(24)) h""",
          {"scenarios": f"""
  SELECT d.date, d.PULocationID, d.category, d.operator_name,
         COALESCE({reven(emean('w.temperature', 6), 1)}, 15.0::DOUBLE) AS temperature,
         COALESCE({reven(emean('w.precipitation', 6), 2)}, 0.0::DOUBLE) AS precipitation,
         COALESCE({reven(emean('w.windspeed', 6), 1)}, 10.0::DOUBLE) AS windspeed
  FROM (SELECT DISTINCT date, PULocationID, category, operator_name FROM agg_hourly_demand
        WHERE date >= DATE '{fx.FIXTURE_CUT}') d
  LEFT JOIN dim_weather w ON w.date = d.date
  GROUP BY 1, 2, 3, 4"""})
def q_scenario_grid(spark, sf_dir):
    scen = ml.scenario_inputs(agg_hourly_df(spark, sf_dir), dim_weather_df(spark, sf_dir), fx.FIXTURE_CUT)
    return ml.scenario_grid(scen)


# --- 2.4 aggregations ---------------------------------------------------------------

@register("agg_hourly_demand", "SELECT * FROM agg_hourly_demand")
def q_agg_hourly_demand(spark, sf_dir):
    return aggregates.agg_hourly_demand(fact_rows_df(spark, sf_dir), zones.dim_operator(spark),
                                        dim_weather_df(spark, sf_dir))


@register("agg_zone_demand", "SELECT * FROM agg_zone_demand")
def q_agg_zone_demand(spark, sf_dir):
    return aggregates.agg_zone_demand(fact_rows_df(spark, sf_dir), zones.dim_operator(spark),
                                      zones.builtin_dim_location(spark))


# the aggregates as the warehouse holds them
@register("warehouse_hourly", "SELECT * FROM agg_hourly_demand")
def q_warehouse_hourly(spark, sf_dir):
    return agg_hourly_df(spark, sf_dir)


@register("warehouse_zone", "SELECT * FROM agg_zone_demand")
def q_warehouse_zone(spark, sf_dir):
    return agg_zone_df(spark, sf_dir)


_WAREHOUSE_SCHEMA = {
    "fact_trips": (
        "trip_id bigint", "operator_code string", "PULocationID int", "DOLocationID int", "pickup_datetime timestamp_ntz",
        "dropoff_datetime timestamp_ntz", "trip_duration_min float", "trip_distance float", "fare_amount float", "tip_amount float",
        "tolls_amount float", "congestion_surcharge float", "airport_fee float", "cbd_congestion_fee float", "total_amount float"),
    "agg_hourly_demand": (
        "date date", "hour int", "day_of_week int", "PULocationID int", "operator_id int", "taxi_type string", "category string",
        "operator_name string", "trip_count bigint", "avg_fare double", "avg_total double", "avg_duration_min double",
        "avg_distance double", "avg_tip double", "temperature double", "precipitation double", "windspeed double", "is_rain int", "is_snow int"),
    "agg_zone_demand": (
        "month timestamp_ntz", "PULocationID int", "zone_name string", "borough string", "taxi_type string", "category string",
        "operator_name string", "trip_count bigint", "avg_fare double", "avg_distance double", "avg_duration_min double", "avg_tip double"),
}


@register("warehouse_schema", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", {i} AS position, '{c.split()[0]}' AS \"column\", '{c.split()[1]}' AS type, "
    f"COUNT({c.split()[0]}) AS non_null FROM {t}"
    for t, cols in _WAREHOUSE_SCHEMA.items() for i, c in enumerate(cols)))
def q_warehouse_schema(spark, sf_dir):
    root = warehouse_root(spark, sf_dir)
    reports_ = [quality.schema_report(job.read_table(spark, root, t)).select(F.lit(t).alias("table"), "*") for t in _WAREHOUSE_SCHEMA]
    return functools.reduce(DataFrame.unionByName, reports_)


@register("zone_profile", "SELECT * FROM zone_profile", ZP)
def q_zone_profile(spark, sf_dir):
    return zone_profile_df(spark, sf_dir)


@register("hourly_profile", "SELECT * FROM hourly_profile", HP)
def q_hourly_profile(spark, sf_dir):
    return hourly_profile_df(spark, sf_dir)


@register("daily_profile", f"""
  SELECT date, category, operator_name, CAST(SUM(trip_count) AS BIGINT) AS trip_count,
         ROUND({emean('avg_fare', 2)}, 2) AS avg_fare, ROUND({emean('avg_tip', 2)}, 2) AS avg_tip
  FROM agg_hourly_demand GROUP BY 1, 2, 3""")
def q_daily_profile(spark, sf_dir):
    return reports.daily_profile(agg_hourly_df(spark, sf_dir))


@register("daily_trend", f"""
  SELECT date, category, CAST(SUM(trip_count) AS BIGINT) AS trip_count
  FROM agg_hourly_demand
  WHERE date >= DATE '{fx.FIXTURE_TREND[0]}' AND date < DATE '{fx.FIXTURE_TREND[1]}'
  GROUP BY 1, 2""")
def q_daily_trend(spark, sf_dir):
    return reports.daily_trend(agg_hourly_df(spark, sf_dir), *fx.FIXTURE_TREND)


@register("kpis", f"""
  SELECT CAST(SUM(trip_count) AS BIGINT) AS total_trips, {emean('avg_fare', 2)} AS avg_fare,
         {emean('avg_tip', 2)} AS avg_tip, {emean('avg_distance', 2)} AS avg_distance,
         COUNT(DISTINCT PULocationID) AS active_zones
  FROM zone_profile""", ZP)
def q_kpis(spark, sf_dir):
    return reports.kpis(zone_profile_df(spark, sf_dir))


@register("zone_map", f"""
  SELECT PULocationID, zone_name, CAST(SUM(trip_count) AS BIGINT) AS trip_count,
         {emean('avg_fare', 2)} AS avg_fare, {emean('avg_distance', 2)} AS avg_distance
  FROM zone_profile WHERE category = 'Konvensional' GROUP BY 1, 2""", ZP)
def q_zone_map(spark, sf_dir):
    return reports.zone_map(zone_profile_df(spark, sf_dir), "Konvensional")


@register("market_share", """
  SELECT category, trip_count, trip_count * 100.0::DOUBLE / SUM(trip_count) OVER () AS percent
  FROM (SELECT category, CAST(SUM(trip_count) AS BIGINT) AS trip_count FROM zone_profile GROUP BY 1)""",
          ZP)
def q_market_share(spark, sf_dir):
    return reports.market_share(zone_profile_df(spark, sf_dir))


@register("operator_volume", """
  SELECT operator_name, CAST(SUM(trip_count) AS BIGINT) AS trip_count
  FROM zone_profile GROUP BY 1 ORDER BY 2 DESC, 1""", ZP)
def q_operator_volume(spark, sf_dir):
    return reports.operator_volume(zone_profile_df(spark, sf_dir))


@register("hour_volume", """
  SELECT hour, category, CAST(SUM(trip_count) AS BIGINT) AS trip_count
  FROM hourly_profile GROUP BY 1, 2""", HP)
def q_hour_volume(spark, sf_dir):
    return reports.hour_volume(hourly_profile_df(spark, sf_dir))


@register("operator_means", f"""
  SELECT operator_name, {emean('avg_fare', 2)} AS avg_fare, {emean('avg_tip', 2)} AS avg_tip,
         {emean('avg_distance', 2)} AS avg_distance
  FROM zone_profile GROUP BY 1""", ZP)
def q_operator_means(spark, sf_dir):
    return reports.operator_means(zone_profile_df(spark, sf_dir))


@register("hour_fare", f"""
  SELECT hour, category, {emean('avg_fare', 2)} AS avg_fare FROM hourly_profile GROUP BY 1, 2""", HP)
def q_hour_fare(spark, sf_dir):
    return reports.hour_fare(hourly_profile_df(spark, sf_dir))


_DAY_LABELS_SQL = "[" + ", ".join(f"'{d}'" for d in reports.DAY_LABELS) + "]"
_ROW_ORDER_SQL = "[" + ", ".join(f"'{d}'" for d in reports.HEATMAP_ROW_ORDER) + "]"


# section -> its keys and values, of the bundle of one month
_BUNDLE = {
    "zone_profile": (("zone_name", "operator_name"), ("trip_count", "avg_fare", "avg_duration_min")),
    "hourly_profile": (("hour", "operator_name"), ("trip_count", "avg_tip", "avg_distance")),
    "kpis": ((), ("total_trips", "avg_fare", "active_zones")),
    "zone_map_konvensional": (("PULocationID", "zone_name"), ("trip_count", "avg_fare", "avg_distance")),
    "zone_map_modern": (("PULocationID", "zone_name"), ("trip_count", "avg_fare", "avg_distance")),
    "top_zones": (("category", "zone_name"), ("trip_count", "rank")),
    "market_share": (("category",), ("trip_count", "percent")),
    "operator_volume": (("operator_name",), ("trip_count",)),
    "hour_volume": (("hour", "category"), ("trip_count",)),
    "demand_heatmap": (("day_label",), ("row_order", "8", "18")),
    "operator_means": (("operator_name",), ("avg_fare", "avg_tip", "avg_distance")),
    "hour_fare": (("hour", "category"), ("avg_fare",)),
    "daily_profile": (("date", "operator_name"), ("trip_count", "avg_fare", "avg_tip")),
    "daily_trend": (("date", "category"), ("trip_count",)),
}
_BUNDLE_MONTH = f"{fx.FIXTURE_MONTHS[1]}-01"


def _bundle_row(keys, values, text, number, null):
    """Two keys as text and three values as doubles, nulls where a section has fewer."""
    keys = [text(k) for k in keys] + [null("VARCHAR")] * (2 - len(keys))
    return keys + [number(v) for v in values] + [null("DOUBLE")] * (3 - len(values))


def _bundle_sql():
    m = "CAST(SUM(trip_count) AS BIGINT)"
    weekday = f"{_DAY_LABELS_SQL}[day_of_week + 1]"
    section = {
        "zone_profile": "SELECT * FROM zp", "hourly_profile": "SELECT * FROM hp",
        "kpis": f"SELECT {m} AS total_trips, {emean('avg_fare', 2)} AS avg_fare, COUNT(DISTINCT PULocationID) AS active_zones FROM zp",
        "top_zones": f"""SELECT * FROM (SELECT category, zone_name, {m} AS trip_count, ROW_NUMBER() OVER (PARTITION BY category ORDER BY SUM(trip_count) DESC, zone_name) AS rank
                         FROM zp GROUP BY 1, 2) WHERE rank <= 10""",
        "market_share": f"SELECT category, {m} AS trip_count, SUM(trip_count) * 100.0::DOUBLE / SUM(SUM(trip_count)) OVER () AS percent FROM zp GROUP BY 1",
        "operator_volume": f"SELECT operator_name, {m} AS trip_count FROM zp GROUP BY 1",
        "hour_volume": f"SELECT hour, category, {m} AS trip_count FROM hp GROUP BY 1, 2",
        "demand_heatmap": f"""SELECT {weekday} AS day_label, list_position({_ROW_ORDER_SQL}, {weekday}) - 1 AS row_order,
                                     SUM(trip_count) FILTER (WHERE hour = 8) AS "8", SUM(trip_count) FILTER (WHERE hour = 18) AS "18" FROM hp GROUP BY day_of_week""",
        "operator_means": f"SELECT operator_name, {', '.join(emean(c, 2) + ' AS ' + c for c in ('avg_fare', 'avg_tip', 'avg_distance'))} FROM zp GROUP BY 1",
        "hour_fare": f"SELECT hour, category, {emean('avg_fare', 2)} AS avg_fare FROM hp GROUP BY 1, 2",
        "daily_profile": f"""SELECT date, operator_name, {m} AS trip_count, {', '.join(f'ROUND({emean(c, 2)}, 2) AS {c}' for c in ('avg_fare', 'avg_tip'))}
                             FROM agg_hourly_demand WHERE date_trunc('month', date) = DATE '{_BUNDLE_MONTH}' GROUP BY date, category, operator_name""",
        "daily_trend": f"SELECT date, category, {m} AS trip_count FROM agg_hourly_demand WHERE date >= '{fx.FIXTURE_TREND[0]}' AND date < '{fx.FIXTURE_TREND[1]}' GROUP BY 1, 2",
    }
    for c in reports.CATEGORIES:
        section[f"zone_map_{c.lower()}"] = f"""SELECT PULocationID, zone_name, {m} AS trip_count, {emean('avg_fare', 2)} AS avg_fare, {emean('avg_distance', 2)} AS avg_distance
                                               FROM zp WHERE category = '{c}' GROUP BY 1, 2"""
    parts = []
    for name, (keys, values) in _BUNDLE.items():
        cells = _bundle_row(keys, values, lambda k: f'CAST("{k}" AS VARCHAR)', lambda v: f'CAST("{v}" AS DOUBLE)', lambda t: f"CAST(NULL AS {t})")
        parts.append(f"SELECT '{name}' AS section, {', '.join(f'{c} AS {n}' for c, n in zip(cells, _BUNDLE_COLUMNS, strict=True))} FROM ({section[name]})")
    return " UNION ALL ".join(parts)


_BUNDLE_COLUMNS = ("key1", "key2", "value1", "value2", "value3")
_BUNDLE_PROFILES = {
    "zp": ZP["zone_profile"].replace("FROM agg_zone_demand", f"FROM agg_zone_demand WHERE month = TIMESTAMP '{_BUNDLE_MONTH}'"),
    "hp": HP["hourly_profile"].replace("FROM agg_hourly_demand", f"FROM agg_hourly_demand WHERE date_trunc('month', date) = DATE '{_BUNDLE_MONTH}'"),
}


@register("report_bundle", _bundle_sql(), _BUNDLE_PROFILES)
def q_report_bundle(spark, sf_dir):
    """Every section of the dashboard for one month, in one long table."""
    bundle = report_bundle(agg_zone_df(spark, sf_dir), agg_hourly_df(spark, sf_dir), _BUNDLE_MONTH, trend_window=fx.FIXTURE_TREND)
    parts = []
    for name, (keys, values) in _BUNDLE.items():
        cells = _bundle_row(keys, values, lambda k: F.col(f"`{k}`").cast("string"), lambda v: F.col(f"`{v}`").cast("double"),
                            lambda t: F.lit(None).cast("string" if t == "VARCHAR" else "double"))
        parts.append(bundle[name].select(F.lit(name).alias("section"), *[c.alias(n) for c, n in zip(cells, _BUNDLE_COLUMNS, strict=True)]))
    return functools.reduce(DataFrame.unionAll, parts)


_DAILY_WEATHER = {"weather_daily": f"""
  SELECT date,
         {reven(emean('temperature', 6), 1)} AS avg_temp,
         {reven('MAX(temperature)', 1)} AS max_temp,
         {reven('MIN(temperature)', 1)} AS min_temp,
         {reven(ssum('precipitation', 6), 1)} AS total_precip,
         {reven('MAX(snowfall)', 1)} AS max_snowfall,
         MAX(is_rain) AS had_rain, MAX(is_snow) AS had_snow
  FROM dim_weather GROUP BY 1"""}


@register("weather_daily", "SELECT * FROM weather_daily", _DAILY_WEATHER)
def q_weather_daily(spark, sf_dir):
    return wx.weather_daily(dim_weather_df(spark, sf_dir))


@register("weather_kpis", f"""
  SELECT {emean('avg_temp', 1)} AS mean_temp, MIN(min_temp) AS lowest_temp,
         CAST(SUM(had_rain) AS BIGINT) AS rain_days, CAST(SUM(had_snow) AS BIGINT) AS snow_days
  FROM weather_daily""", _DAILY_WEATHER)
def q_weather_kpis(spark, sf_dir):
    return wx.weather_kpis(wx.weather_daily(dim_weather_df(spark, sf_dir)))


@register("weather_duplicates", """
  SELECT date, hour, COUNT(*) AS rows FROM dim_weather GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def q_weather_duplicates(spark, sf_dir):
    return wx.duplicate_weather_hours(dim_weather_df(spark, sf_dir))


@register("dim_weather", "SELECT * FROM dim_weather")
def q_dim_weather(spark, sf_dir):
    return wx.build_dim_weather(weather_hourly_df(spark, sf_dir))


@register("actual_vs_predicted", f"""
  SELECT date, category, Tipe, trip_count FROM (
    SELECT date, category, CAST(SUM(trip_count) AS DOUBLE) AS Aktual,
           {ssum('predicted', 1)} AS Prediksi
    FROM baseline_pred GROUP BY 1, 2)
  UNPIVOT (trip_count FOR Tipe IN (Aktual, Prediksi))""", _BASELINE_SQL)
def q_actual_vs_predicted(spark, sf_dir):
    return reports.actual_vs_predicted(baseline_df(spark, sf_dir))


_DEMAND_KEYS = ("date", "hour", "PULocationID", "category", "operator_name", "trip_count", "avg_fare", "avg_total", "avg_duration_min", "avg_distance",
                "avg_tip", "temperature", "is_rain")


@register("agg_refresh", f"""
  SELECT 'hourly' AS source, {", ".join(_DEMAND_KEYS)} FROM agg_hourly_demand
  UNION ALL
  SELECT 'zone', month, NULL, PULocationID, category, operator_name, trip_count, avg_fare, NULL, avg_duration_min, avg_distance, avg_tip, NULL, NULL
  FROM agg_zone_demand""")
def q_agg_refresh(spark, sf_dir):
    """Both demand tables of a warehouse built from all months but the last and then given that one."""
    root = scratch_path(spark, "warehouse-refresh")
    trips, weather = fx.landed(spark, sf_dir).trips, weather_hourly_df(spark, sf_dir)
    early = weather.where(F.to_date("datetime") < F.lit(fx.FIXTURE_CUT).cast("date"))
    job.build_warehouse(spark, trips, root, fx.FIXTURE_MONTHS[:-1], early)
    for _ in range(2):  # the second call finds nothing to do
        job.append_months(spark, trips, root, fx.FIXTURE_MONTHS, weather)
    hourly = job.read_table(spark, root, "agg_hourly_demand").select(F.lit("hourly").alias("source"), *_DEMAND_KEYS)
    zone = job.read_table(spark, root, "agg_zone_demand").withColumnRenamed("month", "date")
    empty = {c: F.lit(None).cast(hourly.schema[c].dataType) for c in _DEMAND_KEYS if c not in zone.columns}
    return hourly.unionByName(zone.withColumns(empty).select(F.lit("zone").alias("source"), *_DEMAND_KEYS))


@register("pipeline_row_counts", """
  SELECT * FROM (VALUES
    ('dim_location', (SELECT COUNT(*) FROM dim_location)),
    ('dim_operator', (SELECT COUNT(*) FROM dim_operator)),
    ('fact_trips', (SELECT COUNT(*) FROM fact_trips)),
    ('agg_hourly_demand', (SELECT COUNT(*) FROM agg_hourly_demand)),
    ('agg_zone_demand', (SELECT COUNT(*) FROM agg_zone_demand))) t("table", row_count)""")
def q_pipeline_row_counts(spark, sf_dir):
    paths = job.build_warehouse(spark, fx.landed(spark, sf_dir).trips, scratch_path(spark, "warehouse"),
                                fx.FIXTURE_MONTHS, weather_hourly_df(spark, sf_dir))
    return job.warehouse_row_counts(spark, paths)


@register("service_counts", """
  SELECT CASE WHEN operator_code IN ('1', '2') THEN 'yellow' ELSE 'fhvhv' END AS service,
         COUNT(*) AS trip_count
  FROM fact_trips WHERE operator_code IN ('1', '2', 'HV0003', 'HV0005') GROUP BY 1""")
def q_service_counts(spark, sf_dir):
    return warehouse.service_counts(fact_rows_df(spark, sf_dir), zones.SERVICE_CODES)


_PROFILE_COLS = ("VendorID", "PULocationID", "DOLocationID", "trip_distance", "fare_amount",
                 "tip_amount", "tolls_amount", "congestion_surcharge", "Airport_fee",
                 "cbd_congestion_fee", "total_amount")


def _quartile_sql(xs: str, n: str, q: float) -> str:
    """NumPy's linear interpolation between the order statistics of sorted list ``xs``."""
    pos = f"(({n} - 1) * {q})"
    lo = f"CAST(floor({pos}) AS BIGINT)"
    d = f"({pos} - floor({pos}))"
    a, b = f"{xs}[{lo} + 1]", f"{xs}[{lo} + 2]"
    return (f"CASE WHEN {n} = 0 THEN NULL WHEN {d} = 0 THEN {a} "
            f"WHEN {d} >= 0.5 THEN {b} - ({b} - {a}) * (1.0 - {d}) "
            f"ELSE {a} + ({b} - {a}) * {d} END")


def _profile_sql(cols=_PROFILE_COLS, source="raw_yellow"):
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        quarts = ", ".join(f"{_quartile_sql('xs', 'n', q)} AS {name}"
                           for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)))
        parts.append(
            f"SELECT '{c}' AS \"column\", n AS count, mean, std, min, {quarts}, max FROM ("
            f"SELECT COUNT({x}) AS n, ROUND(AVG({x}), 6) AS mean, ROUND(STDDEV_SAMP({x}), 6) AS std, "
            f"MIN({x}) AS min, MAX({x}) AS max, list_sort(list({x}) FILTER (WHERE {x} IS NOT NULL)) AS xs "
            f"FROM {source})")
    return " UNION ALL ".join(parts)


@register("profile", _profile_sql())
def q_profile(spark, sf_dir):
    return quality.profile(raw_yellow_df(spark, sf_dir), _PROFILE_COLS)


# the same profile after the exploratory cleaner (before/after comparison)
_EXPLORE_PROFILE_COLS = _PROFILE_COLS + ("trip_duration_min", "hour")


@register("profile_explore", _profile_sql(_EXPLORE_PROFILE_COLS, "explore"), {"explore": _EXPLORE_SQL})
def q_profile_explore(spark, sf_dir):
    return quality.profile(cleaning.explore_clean(raw_yellow_df(spark, sf_dir)), _EXPLORE_PROFILE_COLS)


# columns and Spark types of the raw files, in order
_RAW_COLUMNS = {
    "yellow": (("VendorID", "int"), ("tpep_pickup_datetime", "timestamp_ntz"), ("tpep_dropoff_datetime", "timestamp_ntz"), ("PULocationID", "int"),
               ("DOLocationID", "int"), ("trip_distance", "double"), ("fare_amount", "double"), ("tip_amount", "double"), ("tolls_amount", "double"),
               ("congestion_surcharge", "double"), ("Airport_fee", "double"), ("cbd_congestion_fee", "double"), ("total_amount", "double"), ("file_month", "string")),
    "fhvhv": (("hvfhs_license_num", "string"), ("pickup_datetime", "timestamp_ntz"), ("dropoff_datetime", "timestamp_ntz"), ("PULocationID", "int"),
              ("DOLocationID", "int"), ("trip_miles", "double"), ("base_passenger_fare", "double"), ("tips", "double"), ("tolls", "double"), ("bcf", "double"),
              ("sales_tax", "double"), ("congestion_surcharge", "double"), ("airport_fee", "double"), ("cbd_congestion_fee", "double"), ("file_month", "string")),
}


def _missing_sql(service):
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL" + (f" OR isnan({c})" if t == "double" else "") + f") AS missing FROM raw_{service}"
        for i, (c, t) in enumerate(_RAW_COLUMNS[service]))


def _schema_sql(service):
    return " UNION ALL ".join(f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS type, COUNT({c}) AS non_null FROM raw_{service}"
                              for i, (c, t) in enumerate(_RAW_COLUMNS[service]))


@register("missing_values", _missing_sql("yellow"))
def q_missing_values(spark, sf_dir):
    return quality.missing_values(raw_yellow_df(spark, sf_dir))


@register("missing_values_hvfhv", _missing_sql("fhvhv"))
def q_missing_values_hvfhv(spark, sf_dir):
    return quality.missing_values(raw_fhvhv_df(spark, sf_dir))


@register("schema_report", _schema_sql("yellow"))
def q_schema_report(spark, sf_dir):
    return quality.schema_report(raw_yellow_df(spark, sf_dir))


@register("schema_report_hvfhv", _schema_sql("fhvhv"))
def q_schema_report_hvfhv(spark, sf_dir):
    return quality.schema_report(raw_fhvhv_df(spark, sf_dir))


_PROFILE_COLS_HVFHV = tuple(c for c, t in _RAW_COLUMNS["fhvhv"] if t in ("int", "double"))


@register("profile_hvfhv", _profile_sql(_PROFILE_COLS_HVFHV, "raw_fhvhv"))
def q_profile_hvfhv(spark, sf_dir):
    return quality.profile(raw_fhvhv_df(spark, sf_dir), _PROFILE_COLS_HVFHV)


# --- 2.5 windows ---------------------------------------------------------------------

# Ids follow the place in the written files, so SQL states what they must satisfy: dense
# and unique, yellow first, then month by month.
_ID_BLOCKS_SQL = """
  SELECT service, file_month, n AS trips, CAST(until - n + 1 AS BIGINT) AS first_id, CAST(until AS BIGINT) AS last_id, n AS ids, fare_cents
  FROM (SELECT *, SUM(n) OVER (ORDER BY service DESC, file_month) AS until
        FROM (SELECT service, file_month, COUNT(*) AS n,
                     CAST(SUM(CAST(ROUND(CAST(CAST(fare_amount AS FLOAT) AS DOUBLE) * 100) AS BIGINT)) AS BIGINT) AS fare_cents
              FROM clean_all GROUP BY 1, 2))"""


@register("trip_id", _ID_BLOCKS_SQL)
def q_trip_id(spark, sf_dir):
    return warehouse.id_blocks(fact_df(spark, sf_dir))


@register("operator_share", """
  SELECT category, operator_name, total_trip,
         ROUND(total_trip * 100.0::DOUBLE / SUM(total_trip) OVER (), 1) AS persen
  FROM (SELECT o.category, o.operator_name, COUNT(*) AS total_trip
        FROM fact_trips f JOIN dim_operator o USING (operator_code) GROUP BY 1, 2)""")
def q_operator_share(spark, sf_dir):
    return warehouse.operator_share(fact_rows_df(spark, sf_dir), zones.dim_operator(spark))


# --- 2.6 sort, top-k, reshape ------------------------------------------------------------

@register("fact_append", _ID_BLOCKS_SQL)
def q_fact_append(spark, sf_dir):
    """Yellow trips first, then every file, then every file once more: the ledger lets each in once."""
    files = src.read_clean(spark, f"{warehouse_root(spark, sf_dir)}/clean", months=fx.FIXTURE_MONTHS)
    root = scratch_path(spark, "fact-append")
    for load in (files.filter(F.col("service") == "yellow"), files, files):
        job.load_fact(spark, root, load)
    return warehouse.id_blocks(job.read_table(spark, root, "fact_trips", folder=True))


@register("fact_trips", "SELECT * EXCLUDE (trip_id) FROM fact_trips")
def q_fact_trips(spark, sf_dir):
    """Every column of the loaded fact but the id, whose blocks ``trip_id`` checks."""
    return fact_rows_df(spark, sf_dir)


@register("top_zones", """
  SELECT * FROM (
    SELECT category, zone_name, CAST(SUM(trip_count) AS BIGINT) AS trip_count,
           CAST(ROW_NUMBER() OVER (PARTITION BY category ORDER BY SUM(trip_count) DESC, zone_name)
                AS INTEGER) AS rank
    FROM zone_profile GROUP BY 1, 2) WHERE rank <= 10""", ZP)
def q_top_zones(spark, sf_dir):
    return reports.top_zones(zone_profile_df(spark, sf_dir), 10)


@register("sample_rows", """
  SELECT operator_code, PULocationID, DOLocationID, pickup_datetime, trip_duration_min,
         trip_distance, fare_amount, tip_amount, total_amount
  FROM fact_trips ORDER BY pickup_datetime, operator_code, PULocationID, DOLocationID, trip_duration_min, trip_distance, fare_amount LIMIT 5""")
def q_sample_rows(spark, sf_dir):
    cols = ("operator_code", "PULocationID", "DOLocationID", "pickup_datetime",
            "trip_duration_min", "trip_distance", "fare_amount", "tip_amount", "total_amount")
    order = ("pickup_datetime", "operator_code", "PULocationID", "DOLocationID", "trip_duration_min", "trip_distance", "fare_amount")
    return quality.sample_rows(fact_df(spark, sf_dir), 5, cols, order)


@register("zone_list", "SELECT DISTINCT PULocationID, zone_name FROM agg_zone_demand")
def q_zone_list(spark, sf_dir):
    return reports.zone_list(agg_zone_df(spark, sf_dir))


@register("zone_id_by_name", """
  SELECT zone_name, MAX(PULocationID) AS PULocationID
  FROM (SELECT DISTINCT PULocationID, zone_name FROM agg_zone_demand) GROUP BY 1""")
def q_zone_id_by_name(spark, sf_dir):
    return reports.zone_id_by_name(reports.zone_list(agg_zone_df(spark, sf_dir)))


@register("demand_heatmap", f"""
  SELECT {_DAY_LABELS_SQL}[day_of_week + 1] AS day_label,
         CAST(list_position({_ROW_ORDER_SQL}, {_DAY_LABELS_SQL}[day_of_week + 1]) - 1 AS INTEGER) AS row_order,
         {", ".join(f'CAST(SUM(trip_count) FILTER (WHERE hour = {h}) AS BIGINT) AS "{h}"' for h in range(24))}
  FROM hourly_profile GROUP BY day_of_week""", HP)
def q_demand_heatmap(spark, sf_dir):
    return reports.demand_heatmap(hourly_profile_df(spark, sf_dir))


# --- 2.8 machine learning -----------------------------------------------------------------

@register("demand_features", "SELECT * FROM features", FEAT)
def q_demand_features(spark, sf_dir):
    return features_df(spark, sf_dir)


@register("time_split_counts", f"""
  SELECT 'train' AS split, COUNT(*) AS row_count FROM features WHERE date < DATE '{fx.FIXTURE_CUT}'
  UNION ALL
  SELECT 'test', COUNT(*) FROM features WHERE date >= DATE '{fx.FIXTURE_CUT}'""", FEAT)
def q_time_split_counts(spark, sf_dir):
    train, test = split_df(spark, sf_dir)
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("split"), "row_count")
    return count(train, "train").unionByName(count(test, "test"))


@register("regression_metrics", f"""
  SELECT 'baseline' AS model_name,
         ROUND(sqrt(SUM((trip_count - prediction_clipped) * (trip_count - prediction_clipped)) / COUNT(*)), 4) AS rmse,
         ROUND(SUM(abs(trip_count - prediction_clipped)) / COUNT(*), 4) AS mae,
         ROUND(CASE WHEN sst = 0 THEN CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END
                    ELSE 1.0::DOUBLE - sse / sst END, 4) AS r2,
         (SELECT COUNT(*) FROM train) AS train_rows, COUNT(*) AS test_rows
  FROM (SELECT *,
               SUM((trip_count - prediction_clipped) * (trip_count - prediction_clipped)) OVER () AS sse,
               CAST(SUM(trip_count * trip_count) OVER () AS DOUBLE)
                 - CAST(SUM(trip_count) OVER () AS DOUBLE) * CAST(SUM(trip_count) OVER () AS DOUBLE)
                   / COUNT(*) OVER () AS sst
        FROM baseline)
  GROUP BY sse, sst""", _BASELINE_SQL)
def q_regression_metrics(spark, sf_dir):
    train, test = split_df(spark, sf_dir)
    stats = train.agg(F.count(F.lit(1)).alias("n"),
                      F.avg(F.col("trip_count").cast("double")).alias("mean")).first()
    pred = ml.baseline_predictions(train, test, overall_mean=stats["mean"])
    return ml.regression_metrics(pred, model_name="baseline", train_rows=stats["n"])


# Boosted trees are no SQL; their oracles state what must hold of their results.
_MODEL_CTES = {**_BASELINE_SQL, "n_train": "SELECT COUNT(*) AS n FROM train", "n_test": "SELECT COUNT(*) AS n FROM test"}
_KEYS_SQL = "date, hour, day_of_week, PULocationID, category, operator_name, trip_count"


def _well_formed(column="predicted"):
    """Not negative, and equal to its half-even rounding to 0.1."""
    p = F.col(column)
    return ((p >= 0) & (p == F.bround(p, 1))).alias("well_formed")


@register("fit_demand", """
  SELECT 300 AS trees, true AS depth_within_6, true AS columns_within_13, true AS least_splits, 16 AS features, n AS train_rows,
         n AS rows_of_mean, ROUND((SELECT AVG(CAST(trip_count AS DOUBLE)) FROM train), 4) AS mean
  FROM n_train""", _MODEL_CTES)
def q_fit_demand(spark, sf_dir):
    """The ensemble that was fitted, in one row: its size and limits, and tree 0, the mean."""
    model, train, _ = _session_model(spark, sf_dir)
    per_tree = model.where("tree > 0").groupBy("tree").agg(
        F.max("node").alias("last"), F.count_distinct("feature").alias("columns"), F.count("feature").alias("splits"), F.count(F.lit(1)).alias("nodes"))
    shape = per_tree.agg(F.count(F.lit(1)).cast("int").alias("trees"), (F.max("last") < 2**7).alias("depth_within_6"),
                         (F.max("columns") <= 13).alias("columns_within_13"), F.every(F.col("nodes") == 2 * F.col("splits") + 1).alias("least_splits"))
    mean = model.where("tree = 0").select(F.col("row_count").alias("rows_of_mean"), F.round("value", 4).alias("mean"))
    counted = train.agg(F.count(F.lit(1)).alias("train_rows"))
    return shape.join(counted).join(mean).withColumn("features", F.lit(len(ml.FEATURE_COLS)))


@register("predict", f"SELECT {_KEYS_SQL}, true AS well_formed FROM test", _MODEL_CTES)
def q_predict(spark, sf_dir):
    """Every row of the test split, once, with a well-formed prediction."""
    model, _, test = _session_model(spark, sf_dir)
    return ml.predict_demand(model, test).select(*ml.PREDICTION_KEYS, _well_formed())


@register("feature_importance", " UNION ALL ".join(
    f"SELECT '{f}' AS feature, '{label}' AS label, true AS is_share, true AS sums_to_one FROM n_train" for f, label in ml.FEATURE_LABELS), _MODEL_CTES)
def q_feature_importance(spark, sf_dir):
    model, _, _ = _session_model(spark, sf_dir)
    shares = ml.feature_importance(model, spark)
    total = shares.agg(F.sum("importance")).first()[0]
    return shares.select("feature", "label", F.col("importance").between(0, 1).alias("is_share"), F.lit(abs(total - 1) < 1e-6).alias("sums_to_one"))


@register("model_metrics", f"""
  SELECT '{ml.MODEL_NAME}' AS model_name, n_train.n AS train_rows, n_test.n AS test_rows, true AS beats_baseline
  FROM n_train, n_test""", _MODEL_CTES)
def q_model_metrics(spark, sf_dir):
    """Row counts of the fit, and whether its error is below the historical mean's."""
    model, train, test = _session_model(spark, sf_dir)
    ours = ml.regression_metrics(ml.predict_demand(model, test), train_rows=train.count())
    mean = ml.regression_metrics(baseline_df(spark, sf_dir)).first()["rmse"]
    return ours.select("model_name", "train_rows", "test_rows", (F.col("rmse") < mean).alias("beats_baseline"))


@register("actual_vs_predicted_model", """
  SELECT date, category, t.Tipe, CASE t.Tipe WHEN 'Aktual' THEN CAST(actual AS DOUBLE) END AS actual, true AS not_negative
  FROM (SELECT date, category, SUM(trip_count) AS actual FROM test GROUP BY 1, 2), (VALUES ('Aktual'), ('Prediksi')) t(Tipe)""", _MODEL_CTES)
def q_actual_vs_predicted_model(spark, sf_dir):
    model, _, test = _session_model(spark, sf_dir)
    rows = reports.actual_vs_predicted(ml.predict_demand(model, test))
    return rows.select("date", "category", "Tipe", F.when(F.col("Tipe") == "Aktual", F.col("trip_count")).alias("actual"),
                       (F.col("trip_count") >= 0).alias("not_negative"))


@register("model_roundtrip", f"SELECT {_KEYS_SQL}, true AS same FROM test", _MODEL_CTES)
def q_model_roundtrip(spark, sf_dir):
    """A saved and reloaded model predicts the same for every row."""
    model, _, test = _session_model(spark, sf_dir)
    path = scratch_path(spark, "model")
    ml.save_model(model, path)
    again = ml.predict_demand(ml.load_model(path), test).withColumnRenamed("predicted", "again").drop("prediction_clipped")
    return again.join(ml.predict_demand(model, test), list(ml.PREDICTION_KEYS)).select(
        *ml.PREDICTION_KEYS, (F.col("again") == F.col("predicted")).alias("same"))


@register("model_artifacts", """
  SELECT * FROM (VALUES ('ml_demand_predictions', (SELECT n FROM n_test), 8), ('ml_feature_importance', 16, 2), ('ml_model_metrics', 1, 6))
    t("table", row_count, columns)""", _MODEL_CTES)
def q_model_artifacts(spark, sf_dir):
    """The model's tables as the batch writes and the reports load them."""
    model, _, _ = _session_model(spark, sf_dir)
    root = scratch_path(spark, "model-tables")
    model_job.build_model(spark, root, features_df(spark, sf_dir), fx.FIXTURE_CUT, model=model)
    found = model_job.load_artifacts(spark, root)
    counted = [found[t].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table"), "row_count", F.lit(len(found[t].columns)).alias("columns"))
               for t in model_job.TABLES]
    return functools.reduce(DataFrame.unionByName, counted)


@register("score_scenarios", f"""
  SELECT date, PULocationID, category, operator_name, CAST(h.range AS INTEGER) AS hour, true AS well_formed
  FROM (SELECT DISTINCT date, PULocationID, category, operator_name FROM agg_hourly_demand WHERE date >= DATE '{fx.FIXTURE_CUT}'), range(24) h""")
def q_score_scenarios(spark, sf_dir):
    model, _, _ = _session_model(spark, sf_dir)
    scen = ml.scenario_inputs(agg_hourly_df(spark, sf_dir), dim_weather_df(spark, sf_dir), fx.FIXTURE_CUT)
    scored = ml.score_scenarios(model, ml.scenario_grid(scen))
    return scored.select("date", "PULocationID", "category", "operator_name", "hour", _well_formed())


@register("score_single_hour", """
  SELECT DISTINCT day_of_week, month, hour, PULocationID, category, operator_name, true AS not_negative FROM features""", FEAT)
def q_score_single_hour(spark, sf_dir):
    """Each weekday, month and hour asked of a zone and operator, in mild weather: the unrounded answer."""
    model, _, _ = _session_model(spark, sf_dir)
    asked = features_df(spark, sf_dir).select("day_of_week", "month", "hour", "PULocationID", "category", "operator_name").distinct()
    mild = asked.withColumns({c: F.lit(float(v)) for c, v in wx.WEATHER_DEFAULTS[:3]})
    scored = ml.score_scenarios(model, ml.scenario_grid(mild), rounded=False)
    return scored.select("day_of_week", "month", "hour", "PULocationID", "category", "operator_name", (F.col("predicted") >= 0).alias("not_negative"))
