"""Report queries over the two demand aggregates (never over the fact).

Profiles (zone, hourly, daily) filter and regroup an aggregate table; every
section report regroups a profile. Aggregates are orders of magnitude smaller
than the trips, so these are cheap hash aggregates; a window appears only on
results of a few dozen rows.

Means follow the dashboard: profile levels are SQL means rounded to cents,
section levels are plain (unweighted, unrounded) means of those. Each mean is
taken exactly over the cent values (``exact_mean``), so it does not depend on
the order partial aggregates are merged in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripdemand.functions import exact_mean, round_half_away, scaled_sum

# --- fixed values (must equal the reference's) --------------------------------
ALL_CATEGORIES = "Semua"
CATEGORIES = ("Konvensional", "Modern")
# weekday labels, 0 = Sunday, and the heatmap's row order (Monday first)
DAY_LABELS = ("Min", "Sen", "Sel", "Rab", "Kam", "Jum", "Sab")
HEATMAP_ROW_ORDER = ("Sen", "Sel", "Rab", "Kam", "Jum", "Sab", "Min")
ACTUAL_LABEL, PREDICTED_LABEL = "Aktual", "Prediksi"
# ------------------------------------------------------------------------------


def _cat_filter(df: DataFrame, category: str | None) -> DataFrame:
    if category is None or category == ALL_CATEGORIES:
        return df
    return df.filter(F.col("category") == category)


def _mean2(col: str) -> Column:
    """SQL-level mean of cent values, rounded to cents."""
    return round_half_away(exact_mean(F.col(col), 2), 2).alias(col)


def zone_profile(agg_zone: DataFrame, month: str | None = None,
                 category: str | None = ALL_CATEGORIES) -> DataFrame:
    """Zone x category x operator profile for one month (or all) and category."""
    df = agg_zone
    if month:
        df = df.filter(F.col("month") == F.lit(month).cast("timestamp_ntz"))
    df = _cat_filter(df, category)
    return df.groupBy("PULocationID", "zone_name", "category", "operator_name").agg(
        F.sum("trip_count").alias("trip_count"),
        _mean2("avg_fare"), _mean2("avg_tip"), _mean2("avg_distance"), _mean2("avg_duration_min"))


def _month_range(df: DataFrame, month: str | None) -> DataFrame:
    if not month:
        return df
    start = F.lit(month).cast("date")
    return df.filter((F.col("date") >= start) & (F.col("date") < F.add_months(start, 1)))


def hourly_profile(agg_hourly: DataFrame, month: str | None = None,
                   category: str | None = ALL_CATEGORIES) -> DataFrame:
    """Hour x weekday x category x operator profile."""
    df = _cat_filter(_month_range(agg_hourly, month), category)
    return df.groupBy("hour", "day_of_week", "category", "operator_name").agg(
        F.sum("trip_count").alias("trip_count"),
        _mean2("avg_fare"), _mean2("avg_tip"), _mean2("avg_distance"), _mean2("avg_duration_min"))


def daily_profile(agg_hourly: DataFrame, month: str | None = None,
                  category: str | None = ALL_CATEGORIES) -> DataFrame:
    """Date x category x operator: trips, mean fare, mean tip."""
    df = _cat_filter(_month_range(agg_hourly, month), category)
    return df.groupBy("date", "category", "operator_name").agg(
        F.sum("trip_count").alias("trip_count"), _mean2("avg_fare"), _mean2("avg_tip"))


def daily_trend(agg_hourly: DataFrame, start: str, end: str,
                category: str | None = ALL_CATEGORIES) -> DataFrame:
    """Trips per date and category inside the fixed window [start, end)."""
    df = agg_hourly.filter((F.col("date") >= F.lit(start).cast("date"))
                           & (F.col("date") < F.lit(end).cast("date")))
    return (_cat_filter(df, category).groupBy("date", "category")
            .agg(F.sum("trip_count").alias("trip_count")))


def kpis(zone_prof: DataFrame) -> DataFrame:
    """Headline figures: total trips, mean fare/tip/distance, active zones."""
    return zone_prof.agg(
        F.sum("trip_count").alias("total_trips"),
        exact_mean(F.col("avg_fare"), 2).alias("avg_fare"),
        exact_mean(F.col("avg_tip"), 2).alias("avg_tip"),
        exact_mean(F.col("avg_distance"), 2).alias("avg_distance"),
        F.countDistinct("PULocationID").alias("active_zones"))


def zone_map(zone_prof: DataFrame, category: str) -> DataFrame:
    """Per pickup zone (id, name) of one category: trips, mean fare and distance."""
    return (zone_prof.filter(F.col("category") == category)
            .groupBy("PULocationID", "zone_name")
            .agg(F.sum("trip_count").alias("trip_count"),
                 exact_mean(F.col("avg_fare"), 2).alias("avg_fare"),
                 exact_mean(F.col("avg_distance"), 2).alias("avg_distance")))


def top_zones(zone_prof: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` zone *names* by trips, per category (ties broken by name).

    Grouping is by name, so ids sharing a name count as one zone.
    """
    by_name = (zone_prof.groupBy("category", "zone_name")
               .agg(F.sum("trip_count").alias("trip_count")))
    rank = F.row_number().over(Window.partitionBy("category")
                               .orderBy(F.col("trip_count").desc(), F.col("zone_name").asc()))
    return by_name.withColumn("rank", rank).filter(F.col("rank") <= k)


def market_share(zone_prof: DataFrame) -> DataFrame:
    """Trips per category and percent of all trips (a two-row result)."""
    per_cat = zone_prof.groupBy("category").agg(F.sum("trip_count").alias("trip_count"))
    total = F.sum("trip_count").over(Window.partitionBy())
    return per_cat.withColumn("percent", F.col("trip_count") * 100.0 / total)


def operator_volume(zone_prof: DataFrame) -> DataFrame:
    """Trips per operator, most first."""
    return (zone_prof.groupBy("operator_name").agg(F.sum("trip_count").alias("trip_count"))
            .orderBy(F.col("trip_count").desc(), "operator_name"))


def hour_volume(hourly_prof: DataFrame) -> DataFrame:
    """Trips per hour and category."""
    return hourly_prof.groupBy("hour", "category").agg(F.sum("trip_count").alias("trip_count"))


def operator_means(zone_prof: DataFrame) -> DataFrame:
    """Mean fare, tip and distance per operator (three bar charts in one table)."""
    return zone_prof.groupBy("operator_name").agg(
        exact_mean(F.col("avg_fare"), 2).alias("avg_fare"),
        exact_mean(F.col("avg_tip"), 2).alias("avg_tip"),
        exact_mean(F.col("avg_distance"), 2).alias("avg_distance"))


def hour_fare(hourly_prof: DataFrame) -> DataFrame:
    """Mean fare per hour and category."""
    return (hourly_prof.groupBy("hour", "category")
            .agg(exact_mean(F.col("avg_fare"), 2).alias("avg_fare")))


def demand_heatmap(hourly_prof: DataFrame) -> DataFrame:
    """Weekday x hour trip matrix: one row per weekday (Monday first), columns 0..23.

    Pivot values are fixed, so Spark needs no extra pass to find them; cells
    without trips stay null.
    """
    labels = F.element_at(F.array(*[F.lit(x) for x in DAY_LABELS]), F.col("day_of_week") + 1)
    order = F.array_position(F.array(*[F.lit(x) for x in HEATMAP_ROW_ORDER]), labels) - 1
    wide = (hourly_prof.groupBy("day_of_week").pivot("hour", list(range(24)))
            .agg(F.sum("trip_count")))
    return wide.select(labels.alias("day_label"), order.cast("int").alias("row_order"),
                       *[F.col(str(h)) for h in range(24)])


def zone_list(agg_zone: DataFrame) -> DataFrame:
    """Distinct (zone id, zone name) pairs seen in the zone aggregate."""
    return agg_zone.select("PULocationID", "zone_name").distinct()


def zone_id_by_name(zones: DataFrame) -> DataFrame:
    """Name -> id lookup; names shared by several ids resolve to the largest id."""
    return zones.groupBy("zone_name").agg(F.max("PULocationID").alias("PULocationID"))


def zone_features(feature_collection: DataFrame, metrics: DataFrame) -> DataFrame:
    """Zone polygons left-joined to zone metrics by ``LocationID``.

    Features without metrics stay, with null metrics. Geometry is passed
    through as JSON text.
    """
    feats = (feature_collection.select(F.explode("features").alias("f"))
             .select(F.col("f.properties.LocationID").alias("LocationID"),
                     F.to_json("f.geometry").alias("geometry")))
    m = metrics.withColumnRenamed("PULocationID", "LocationID")
    return feats.join(m, "LocationID", "left")


def actual_vs_predicted(pred: DataFrame) -> DataFrame:
    """Per date and category: actual and predicted trips, in long form."""
    wide = pred.groupBy("date", "category").agg(
        F.sum("trip_count").cast("double").alias(ACTUAL_LABEL),
        scaled_sum(F.col("predicted"), 1).alias(PREDICTED_LABEL))
    return wide.unpivot(["date", "category"], [ACTUAL_LABEL, PREDICTED_LABEL],
                        "Tipe", "trip_count")
