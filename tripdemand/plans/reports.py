"""The report bundle: every dashboard section as a lazy DataFrame.

Two profiles (zone and hourly) are computed for the chosen month and category, and each is
regrouped for all its sections in one pass over grouping sets, kept in the checkpoint
folder (a few thousand rows). Sections are filters of that. Nothing is collected here;
callers decide which sections leave Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdemand.functions import exact_mean
from tripdemand.operators import reports as r
from tripdemand.session import checkpoint_dir

# Display order of each section (applied at the report edge only; every
# section is a few dozen to a few thousand rows, so the sort is cheap).
# A leading "-" means descending.
SECTION_ORDER = {
    "zone_profile": ("-trip_count", "zone_name", "category", "operator_name"),
    "hourly_profile": ("hour", "day_of_week", "category", "operator_name"),
    "daily_profile": ("date", "category", "operator_name"),
    "daily_trend": ("date", "category"),
    "zone_map_konvensional": ("-trip_count", "zone_name"),
    "zone_map_modern": ("-trip_count", "zone_name"),
    "top_zones": ("category", "rank"),
    "market_share": ("-trip_count",),
    "hour_volume": ("hour", "category"),
    "demand_heatmap": ("row_order",),
    "operator_means": ("operator_name",),
    "hour_fare": ("hour", "category"),
}


def _order(spec):
    return [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in spec]


#: The grouping sets of each profile: section -> the keys it regroups by. The first is the profile itself.
ZONE_SETS = {
    "zone_profile": ("PULocationID", "zone_name", "category", "operator_name"),
    "zone_map": ("PULocationID", "zone_name", "category"),
    "top_zones": ("zone_name", "category"),
    "market_share": ("category",),
    "operators": ("operator_name",),
    "kpis": (),
}
HOURLY_SETS = {
    "hourly_profile": ("hour", "day_of_week", "category", "operator_name"),
    "hour_volume": ("hour", "category"),
    "demand_heatmap": ("day_of_week", "hour"),
}


def regrouped(profile: DataFrame, sets: dict[str, tuple[str, ...]]) -> DataFrame:
    """All sections of a profile from one pass: ``section``, the keys (null where not grouped by), trips and means.

    Means are exact means of the profile rows' means, as each section states them.
    """
    keys = [F.col(k) for k in next(iter(sets.values()))]
    means = [c for c in ("avg_fare", "avg_tip", "avg_distance", "avg_duration_min") if c in profile.columns]
    rows = profile.groupingSets([[F.col(k) for k in s] for s in sets.values()], *keys).agg(
        F.grouping_id().alias("_set"), F.sum("trip_count").alias("trip_count"), *[exact_mean(F.col(c), 2).alias(c) for c in means],
        F.count_distinct(keys[0]).alias("_first_keys"))
    number = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(next(iter(sets.values()))) if k not in s) for name, s in sets.items()}
    section = F.coalesce(*(F.when(F.col("_set") == n, F.lit(name)) for name, n in number.items()))
    return rows.withColumn("section", section).drop("_set")


def _section(rows: DataFrame, sets: dict[str, tuple[str, ...]], name: str, *values: str) -> DataFrame:
    return rows.where(F.col("section") == name).select(*sets[name], *values)


def report_bundle(agg_zone: DataFrame, agg_hourly: DataFrame, month: str | None = None,
                  category: str = r.ALL_CATEGORIES, trend_window: tuple[str, str] | None = None,
                  top_k: int = 10) -> dict[str, DataFrame]:
    """Dashboard sections for one (month, category) choice.

    ``trend_window`` is the fixed [start, end) date window of the daily trend,
    which ignores the month choice.
    """
    checkpoint_dir(agg_zone.sparkSession)
    zone = regrouped(r.zone_profile(agg_zone, month, category), ZONE_SETS).checkpoint()
    hourly = regrouped(r.hourly_profile(agg_hourly, month, category), HOURLY_SETS).checkpoint()
    whole = ("trip_count", "avg_fare", "avg_tip", "avg_distance", "avg_duration_min")
    maps = _section(zone, ZONE_SETS, "zone_map", "trip_count", "avg_fare", "avg_distance")
    operators = _section(zone, ZONE_SETS, "operators", "trip_count", "avg_fare", "avg_tip", "avg_distance")
    by_hour = _section(hourly, HOURLY_SETS, "hour_volume", "trip_count", "avg_fare")
    bundle = {
        "zone_profile": _section(zone, ZONE_SETS, "zone_profile", *whole),
        "hourly_profile": _section(hourly, HOURLY_SETS, "hourly_profile", *whole),
        "daily_profile": r.daily_profile(agg_hourly, month, category),
        "kpis": _section(zone, ZONE_SETS, "kpis", F.col("trip_count").alias("total_trips"), "avg_fare", "avg_tip", "avg_distance", F.col("_first_keys").alias("active_zones")),
        "zone_map_konvensional": maps.where("category = 'Konvensional'").drop("category"),
        "zone_map_modern": maps.where("category = 'Modern'").drop("category"),
        "top_zones": r.top_zones(_section(zone, ZONE_SETS, "top_zones", "trip_count").select("category", "zone_name", "trip_count"), top_k),
        "market_share": r.market_share(_section(zone, ZONE_SETS, "market_share", "trip_count")),
        "operator_volume": operators.select("operator_name", "trip_count").orderBy(F.col("trip_count").desc(), "operator_name"),
        "hour_volume": by_hour.select("hour", "category", "trip_count"),
        "demand_heatmap": r.demand_heatmap(_section(hourly, HOURLY_SETS, "demand_heatmap", "trip_count")),
        "operator_means": operators.select("operator_name", "avg_fare", "avg_tip", "avg_distance"),
        "hour_fare": by_hour.select("hour", "category", "avg_fare"),
    }
    if trend_window:
        bundle["daily_trend"] = r.daily_trend(agg_hourly, *trend_window, category)
    return bundle


def for_display(bundle: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The bundle's sections in their display order (sorting only at the edge)."""
    return {name: (df.orderBy(*_order(SECTION_ORDER[name])) if name in SECTION_ORDER else df)
            for name, df in bundle.items()}


def release(bundle: dict[str, DataFrame]) -> None:
    """Nothing is held in memory: the profiles' regroupings lie in the checkpoint folder, and Spark's cleaner removes them."""
