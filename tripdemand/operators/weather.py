"""Hourly weather: payload parsing, the weather dimension and weather reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdemand.functions import exact_mean, round_half_even, scaled_sum

# Payload field -> weather column (public hourly variable names).
PAYLOAD_FIELDS = (
    ("temperature_2m", "temperature", "double"),
    ("apparent_temperature", "feels_like", "double"),
    ("precipitation", "precipitation", "double"),
    ("snowfall", "snowfall", "double"),
    ("windspeed_10m", "windspeed", "double"),
    ("weathercode", "weathercode", "int"),
)
PAYLOAD_SCHEMA = ("hourly struct<time: array<string>, "
                  + ", ".join(f"{src}: array<{t}>" for src, _, t in PAYLOAD_FIELDS) + ">")

# decimals that raw measures are summed at; finer ones are rounded
MEASURE_PLACES = 6
RAIN_THRESHOLD_MM = 0.1
FILLED_MEASURES = ("temperature", "feels_like", "precipitation", "snowfall", "windspeed")
# Feature defaults when a trip hour has no weather row (fallback training path).
WEATHER_DEFAULTS = (("temperature", 15.0), ("precipitation", 0.0), ("windspeed", 10.0),
                    ("is_rain", 0), ("is_snow", 0))


def weather_payload(hourly: DataFrame) -> DataFrame:
    """Hourly rows -> one payload per day, each a struct of parallel arrays.

    The public archive answers one request with parallel arrays under
    ``hourly``; chunking by day keeps every payload at <= 24 entries, so no
    single record (or task) ever holds the whole period.
    """
    # the payload's local time text, from calendar fields (zone-free)
    dt = F.col("datetime")
    text = F.concat(F.date_format(F.to_date(dt), "yyyy-MM-dd"), F.lit("T"),
                    F.lpad(F.hour(dt).cast("string"), 2, "0"), F.lit(":"),
                    F.lpad(F.minute(dt).cast("string"), 2, "0"))
    entry = F.struct(dt.alias("_t"), text.alias("time"),
                     *[F.col(dst).alias(src) for src, dst, _ in PAYLOAD_FIELDS])
    per_day = (hourly.groupBy(F.to_date("datetime").alias("day"))
               .agg(F.array_sort(F.collect_list(entry)).alias("e")))
    arrays = [F.col("e.time").alias("time")] + [F.col(f"e.{src}").alias(src) for src, _, _ in PAYLOAD_FIELDS]
    return per_day.select(F.to_json(F.struct(F.struct(*arrays).alias("hourly"))).alias("payload"))


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Payload texts (``value``) of files that hold one payload over any number of lines, or one a line.

    A file is read as a whole: one payload covers a period of hours, a few megabytes for
    many years. If the first line that is not blank is a whole JSON value, every line is a payload.
    """
    whole = spark.read.text(path, wholetext=True).where(F.trim(F.regexp_replace("value", r"\s+", " ")) != "")
    first = F.regexp_extract("value", r"^\s*([^\r\n]*)", 1)
    payloads = F.when(F.try_parse_json(first).isNotNull(), F.split("value", r"[\r\n]+")).otherwise(F.array("value"))
    return whole.select(F.explode(payloads).alias("value")).where(F.trim("value") != "")


def explode_weather(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """JSON payloads of parallel arrays -> one row per hour.

    ``from_json`` with a fixed schema, ``arrays_zip`` to pair the i-th
    elements, ``inline`` to emit them; every payload is handled in the task
    that reads it.
    """
    parsed = payloads.select(F.from_json(F.col(column), PAYLOAD_SCHEMA, {"mode": "FAILFAST"}).alias("p"), F.col(column).alias("_raw"))
    hours = F.size("p.hourly.time")
    whole = F.lit(True)
    for name, _, _ in PAYLOAD_FIELDS:
        whole = whole & (F.coalesce(F.size(f"p.hourly.{name}"), F.lit(-1)) == hours)
    # a payload without its arrays, or with arrays of unequal length, must not vanish or shift
    bad = F.raise_error(F.concat(F.lit("weather payload without hourly arrays of equal length: "), F.substring("_raw", 1, 200)))
    parsed = parsed.select(F.when(F.coalesce(hours >= 0, F.lit(False)) & whole, F.col("p")).otherwise(bad).alias("p"))
    zipped = F.arrays_zip(F.col("p.hourly.time").alias("time"),
                          *[F.col(f"p.hourly.{src}").alias(dst) for src, dst, _ in PAYLOAD_FIELDS])
    return (parsed.select(F.inline(zipped))
            .select(F.to_timestamp_ntz(F.col("time"), F.lit("yyyy-MM-dd'T'HH:mm")).alias("datetime"),
                    *[dst for _, dst, _ in PAYLOAD_FIELDS]))


def build_dim_weather(hourly: DataFrame) -> DataFrame:
    """Hourly weather -> ``dim_weather``: date/hour keys, flags, null fills.

    Flags are computed before the fill, and a null measure counts as "no".
    """
    flag = lambda cond: F.coalesce(cond, F.lit(False)).cast("int")
    return hourly.select(
        F.to_date("datetime").alias("date"),
        F.hour("datetime").alias("hour"),
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in FILLED_MEASURES],
        F.coalesce(F.col("weathercode"), F.lit(0)).cast("int").alias("weathercode"),
        flag(F.col("precipitation") > RAIN_THRESHOLD_MM).alias("is_rain"),
        flag(F.col("snowfall") > 0.0).alias("is_snow"),
    )


def weather_daily(dim_weather: DataFrame) -> DataFrame:
    """Daily weather summary, every value rounded half-even to one decimal.

    Means and sums are exact over measures of up to six decimals, so the
    half-even rounding sees the same value on every run and engine.
    """
    daily = dim_weather.groupBy("date").agg(
        exact_mean(F.col("temperature"), MEASURE_PLACES).alias("avg_temp"),
        F.max("temperature").alias("max_temp"),
        F.min("temperature").alias("min_temp"),
        scaled_sum(F.col("precipitation"), MEASURE_PLACES).alias("total_precip"),
        F.max("snowfall").alias("max_snowfall"),
        F.max("is_rain").alias("had_rain"),
        F.max("is_snow").alias("had_snow"),
    )
    return daily.select(
        "date",
        *[round_half_even(F.col(c), 1).alias(c)
          for c in ("avg_temp", "max_temp", "min_temp", "total_precip", "max_snowfall")],
        "had_rain", "had_snow",
    )


def weather_kpis(daily: DataFrame) -> DataFrame:
    """Period mean temperature, lowest temperature, rain days and snow days."""
    return daily.agg(
        exact_mean(F.col("avg_temp"), 1).alias("mean_temp"),
        F.min("min_temp").alias("lowest_temp"),
        F.sum("had_rain").cast("long").alias("rain_days"),
        F.sum("had_snow").cast("long").alias("snow_days"),
    )


def weather_by_hour(dim_weather: DataFrame) -> DataFrame:
    """Weather collapsed to one row per (date, hour) with its row multiplicity.

    ``(date, hour)`` is meant to be unique; if it is not, a per-trip join
    would repeat each trip once per weather row, so the multiplicity is kept
    and applied to trip counts, and the measures are averaged over the
    repeated rows, exactly as the per-trip join would.
    """
    return dim_weather.groupBy("date", "hour").agg(
        F.count(F.lit(1)).alias("_w_rows"),
        F.avg("temperature").alias("_w_temperature"),
        F.avg("precipitation").alias("_w_precipitation"),
        F.avg("windspeed").alias("_w_windspeed"),
        F.max(F.coalesce("is_rain", F.lit(0))).alias("_w_is_rain"),
        F.max(F.coalesce("is_snow", F.lit(0))).alias("_w_is_snow"),
    )


def duplicate_weather_hours(dim_weather: DataFrame) -> DataFrame:
    """(date, hour) keys that occur more than once (should be empty)."""
    return (dim_weather.groupBy("date", "hour").agg(F.count(F.lit(1)).alias("rows"))
            .filter(F.col("rows") > 1))


def demand_weather_defaults(demand: DataFrame, dim_weather: DataFrame) -> DataFrame:
    """Hourly demand left-joined to hourly weather, gaps filled with defaults.

    The demand's own weather columns are replaced by the weather table's;
    hours without weather get 15 degrees, no rain, 10 km/h wind.
    """
    measures = [c for c, _ in WEATHER_DEFAULTS]
    base = demand.drop(*[c for c in measures if c in demand.columns])
    w = dim_weather.select("date", "hour", *measures)
    joined = base.join(w, ["date", "hour"], "left")
    return joined.na.fill({c: v for c, v in WEATHER_DEFAULTS})
