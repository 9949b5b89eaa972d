"""Cleaning: two services' raw trips -> one canonical trip schema.

The filters are plain column predicates, so Catalyst pushes the comparable
ones (fare, distance, the zone-id IN lists) into the Parquet scan and evaluates the
computed duration right after it, inside the same codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripdemand.functions import boundary_diff, round_half_away
from tripdemand.sources.zones import ZONE_IDS

# Canonical clean-trip columns, in order.
CLEAN_COLUMNS = (
    "operator_code", "PULocationID", "DOLocationID",
    "pickup_datetime", "dropoff_datetime", "trip_duration_min",
    "trip_distance", "fare_amount", "tip_amount", "tolls_amount",
    "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "total_amount",
)
# Columns that identify where a row was landed; carried through when present.
CARRY_COLUMNS = ("file_month",)

MIN_TRIP_SECONDS = 60
MAX_TRIP_SECONDS = 10_800
MAX_TRIP_DISTANCE = 100.0


def _carry(raw: DataFrame) -> list[str]:
    return [c for c in CARRY_COLUMNS if c in raw.columns]


def duration_min(start: Column, end: Column) -> Column:
    """Trip minutes from boundary-counted seconds, rounded half away to 2 places."""
    return round_half_away(boundary_diff("second", start, end) / 60.0, 2)


def in_ids(column: str, ids) -> Column:
    """``column IN (ids)`` as one SQL expression (the optimizer turns it into a hash set)."""
    return F.expr(f"`{column}` IN ({', '.join(str(int(i)) for i in ids)})")


def zone_filter(pu: str, do: str, zone_ids=ZONE_IDS) -> Column:
    """Both trip ends inside the kept zones."""
    return in_ids(pu, zone_ids) & in_ids(do, zone_ids)


def trip_rules(pickup: Column, dropoff: Column, fare: Column, distance: Column) -> Column:
    """Fare, distance and time rules shared by both services."""
    seconds = boundary_diff("second", pickup, dropoff)
    return ((fare > 0) & (distance > 0) & (distance < MAX_TRIP_DISTANCE)
            & (dropoff > pickup) & seconds.between(MIN_TRIP_SECONDS, MAX_TRIP_SECONDS))


def clean_yellow(raw: DataFrame, zone_ids=ZONE_IDS) -> DataFrame:
    """Yellow-cab trips conformed to the canonical schema, invalid rows dropped."""
    p, d = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    keep = (zone_filter("PULocationID", "DOLocationID", zone_ids)
            & trip_rules(p, d, F.col("fare_amount"), F.col("trip_distance")))
    return raw.filter(keep).select(
        F.col("VendorID").cast("string").alias("operator_code"),
        "PULocationID", "DOLocationID",
        p.alias("pickup_datetime"), d.alias("dropoff_datetime"),
        duration_min(p, d).alias("trip_duration_min"),
        "trip_distance", "fare_amount", "tip_amount", "tolls_amount",
        F.coalesce("congestion_surcharge", F.lit(0.0)).alias("congestion_surcharge"),
        F.coalesce("Airport_fee", F.lit(0.0)).alias("airport_fee"),
        F.coalesce("cbd_congestion_fee", F.lit(0.0)).alias("cbd_congestion_fee"),
        "total_amount",
        F.lit("yellow").alias("service"),
        *_carry(raw),
    )


def hvfhv_total() -> Column:
    """Passenger total from the raw charge columns, rounded to cents.

    Built from the source surcharges, not their zero-filled versions, so a
    missing charge makes the total null.
    """
    terms = ["base_passenger_fare", "tolls", "bcf", "sales_tax",
             "congestion_surcharge", "airport_fee", "tips", "cbd_congestion_fee"]
    total = F.col(terms[0])
    for name in terms[1:]:
        total = total + F.col(name)
    return round_half_away(total, 2)


def clean_hvfhv(raw: DataFrame, zone_ids=ZONE_IDS) -> DataFrame:
    """High-volume for-hire trips conformed to the canonical schema."""
    p, d = F.col("pickup_datetime"), F.col("dropoff_datetime")
    keep = (zone_filter("PULocationID", "DOLocationID", zone_ids)
            & trip_rules(p, d, F.col("base_passenger_fare"), F.col("trip_miles")))
    return raw.filter(keep).select(
        F.col("hvfhs_license_num").alias("operator_code"),
        "PULocationID", "DOLocationID",
        p.alias("pickup_datetime"), d.alias("dropoff_datetime"),
        duration_min(p, d).alias("trip_duration_min"),
        F.col("trip_miles").alias("trip_distance"),
        F.col("base_passenger_fare").alias("fare_amount"),
        F.col("tips").alias("tip_amount"),
        F.col("tolls").alias("tolls_amount"),
        F.coalesce("congestion_surcharge", F.lit(0.0)).alias("congestion_surcharge"),
        F.coalesce("airport_fee", F.lit(0.0)).alias("airport_fee"),
        F.coalesce("cbd_congestion_fee", F.lit(0.0)).alias("cbd_congestion_fee"),
        hvfhv_total().alias("total_amount"),
        F.lit("fhvhv").alias("service"),
        *_carry(raw),
    )


def union_clean(*cleaned: DataFrame) -> DataFrame:
    """Stack cleaned services into one trip set (by column name)."""
    out = cleaned[0]
    for df in cleaned[1:]:
        out = out.unionByName(df)
    return out


def zone_semi(raw: DataFrame, zones: DataFrame,
              pu: str = "PULocationID", do: str = "DOLocationID") -> DataFrame:
    """Zone restriction as two semi joins against the (broadcast) zone dimension.

    Same rows as the ``isin`` filter of the cleaners; useful when the zone set
    is a table rather than a literal list. The zone table is a lookup of at
    most a few hundred rows.
    """
    ids = F.broadcast(zones.select(F.col("location_id").alias("_zone_id")).distinct())
    return (raw.join(ids, F.col(pu) == F.col("_zone_id"), "left_semi")
            .join(ids, F.col(do) == F.col("_zone_id"), "left_semi"))


def explore_clean(raw: DataFrame) -> DataFrame:
    """Looser exploratory cleaner over raw yellow trips (all columns kept).

    fare, distance and total positive, both zone ids present, 1..180
    boundary-counted minutes; adds the minute duration, pickup hour and
    English weekday name.
    """
    p, d = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    minutes = boundary_diff("minute", p, d)
    keep = ((F.col("fare_amount") > 0) & (F.col("trip_distance") > 0)
            & (F.col("total_amount") > 0)
            & F.col("PULocationID").isNotNull() & F.col("DOLocationID").isNotNull()
            & minutes.between(1, 180))
    return raw.filter(keep).select(
        "*",
        minutes.alias("trip_duration_min"),
        F.hour(p).alias("hour"),
        F.date_format(F.to_date(p), "EEEE").alias("day_of_week"),
    )


def _raw_order(raw: DataFrame) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in raw.columns]


def negative_fares(raw: DataFrame, n: int = 10, fare: str = "fare_amount") -> DataFrame:
    """First ``n`` rows (in a total column order) with a non-positive fare.

    Top-k: each partition keeps its own n best rows, the driver merges
    n x partitions rows, never the whole anomaly set.
    """
    return raw.filter(F.col(fare) <= 0).orderBy(*_raw_order(raw)).limit(n)


def invalid_distances(raw: DataFrame, n: int = 10, distance: str = "trip_distance") -> DataFrame:
    """First ``n`` rows (in a total column order) with a non-positive distance."""
    return raw.filter(F.col(distance) <= 0).orderBy(*_raw_order(raw)).limit(n)


_SERVICE_COLUMNS = {
    "yellow": ("tpep_pickup_datetime", "tpep_dropoff_datetime", "fare_amount", "trip_distance"),
    "fhvhv": ("pickup_datetime", "dropoff_datetime", "base_passenger_fare", "trip_miles"),
}


def reject_reasons(raw: DataFrame, service: str, zone_ids=ZONE_IDS) -> DataFrame:
    """Rows failing each cleaning rule, and rows for which it is the first failure.

    One pass with conditional sums (partial aggregation, one row per task),
    then the single wide row is unpivoted to one row per rule. Rule order is
    the order the rules are written in; ``kept`` + the sum of first failures
    equals ``all_rows``.
    """
    p_name, d_name, fare_name, dist_name = _SERVICE_COLUMNS[service]
    p, d = F.col(p_name), F.col(d_name)
    seconds = boundary_diff("second", p, d)
    rules = [
        ("pickup_zone", in_ids("PULocationID", zone_ids)),
        ("dropoff_zone", in_ids("DOLocationID", zone_ids)),
        ("fare_positive", F.col(fare_name) > 0),
        ("distance_positive", F.col(dist_name) > 0),
        ("distance_below_max", F.col(dist_name) < MAX_TRIP_DISTANCE),
        ("dropoff_after_pickup", d > p),
        ("duration_in_range", seconds.between(MIN_TRIP_SECONDS, MAX_TRIP_SECONDS)),
    ]
    fails = [(name, ~F.coalesce(cond, F.lit(False))) for name, cond in rules]
    aggs = [F.count(F.lit(1)).alias("all_rows__n"), F.count(F.lit(1)).alias("all_rows__f")]
    passed_before = F.lit(True)
    for name, failed in fails:
        aggs.append(F.count(F.when(failed, 1)).alias(f"{name}__n"))
        aggs.append(F.count(F.when(passed_before & failed, 1)).alias(f"{name}__f"))
        passed_before = passed_before & ~failed
    aggs.append(F.count(F.when(passed_before, 1)).alias("kept__n"))
    aggs.append(F.count(F.when(passed_before, 1)).alias("kept__f"))
    wide = raw.agg(*aggs)
    names = ["all_rows"] + [n for n, _ in rules] + ["kept"]
    entries = F.array(*[
        F.struct(F.lit(i).alias("rule_order"), F.lit(n).alias("rule"),
                 F.col(f"{n}__n").alias("failed_rows"), F.col(f"{n}__f").alias("first_failed_rows"))
        for i, n in enumerate(names)])
    return (wide.select(F.inline(entries))
            .select(F.lit(service).alias("service"), "rule_order", "rule",
                    "failed_rows", "first_failed_rows"))
