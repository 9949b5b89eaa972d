"""Star-schema load: fact table with dense trip ids, plus dimension helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripdemand.functions import round_half_away
from tripdemand.operators.ids import file_row_numbers

# Loading order: services in this order, then file month, then file and place in it.
SERVICE_ORDER = ("yellow", "fhvhv")

FACT_TYPES = (
    ("trip_id", "bigint"),
    ("operator_code", "string"),
    ("PULocationID", "int"),
    ("DOLocationID", "int"),
    ("pickup_datetime", "timestamp_ntz"),
    ("dropoff_datetime", "timestamp_ntz"),
    ("trip_duration_min", "float"),
    ("trip_distance", "float"),
    ("fare_amount", "float"),
    ("tip_amount", "float"),
    ("tolls_amount", "float"),
    ("congestion_surcharge", "float"),
    ("airport_fee", "float"),
    ("cbd_congestion_fee", "float"),
    ("total_amount", "float"),
)
FACT_COLUMNS = tuple(name for name, _ in FACT_TYPES)


def to_fact_schema(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cast to the fact table's declared types (32-bit floats for amounts)."""
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in FACT_TYPES], *keep)


def conform_fact(clean: DataFrame) -> DataFrame:
    """Clean trips in fact types, without ids: all that the aggregates read."""
    return clean.select(*[F.col(n).cast(t).alias(n) for n, t in FACT_TYPES if n != "trip_id"])


def fact_of_files(clean_files: DataFrame, first_id: int = 1, keep: tuple[str, ...] = ()) -> DataFrame:
    """A scan of the written clean zone -> ``fact_trips``: yellow first, then month, file and place in it."""
    numbered = file_row_numbers(clean_files.withColumn("_rank", _service_rank()), ["_rank", "file_month"], "trip_id", first_id)
    return to_fact_schema(numbered, keep)


def _service_rank() -> Column:
    return F.when(F.col("service") == SERVICE_ORDER[0], 0).otherwise(1)


def max_trip_id(fact: DataFrame) -> DataFrame:
    """Highest id in an existing fact table (0 when empty)."""
    return fact.agg(F.coalesce(F.max("trip_id"), F.lit(0).cast("bigint")).alias("max_trip_id"))


def not_loaded(clean_files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Clean trips of the (service, file month)s that the load ledger does not name.

    The ledger's keys, one for each loaded file month, become a filter on the clean zone's
    folders: loaded ones are not opened, and rows keep their place in their files.
    """
    loaded: dict[str, list[str]] = {}
    for r in ledger.select("service", "file_month").collect():
        loaded.setdefault(r.service, []).append(r.file_month)
    for service, months in sorted(loaded.items()):
        clean_files = clean_files.filter((F.col("service") != service) | ~F.col("file_month").isin(sorted(months)))
    return clean_files


def next_trip_id(ledger: DataFrame) -> int:
    """The id after the last one that the ledger has given out."""
    return int(ledger.agg(F.coalesce(F.max(F.col("first_id") + F.col("row_count")), F.lit(1))).first()[0])


def ledger_rows(clean_files: DataFrame, first_id: int = 1) -> DataFrame:
    """One row per (service, file month): its trips and the first id that ``fact_of_files`` gives them."""
    counts = clean_files.groupBy("service", "file_month").agg(F.count(F.lit(1)).alias("row_count"))
    before = Window.orderBy(_service_rank(), "file_month").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("service", "file_month", "row_count", (F.coalesce(F.sum("row_count").over(before), F.lit(0)) + first_id).alias("first_id"))


def id_blocks(fact: DataFrame) -> DataFrame:
    """Per service and file month: trips, first and last id, different ids, and fare cents.

    What a load must satisfy: ids dense and unique, yellow first, then by month.
    """
    service = F.when(F.col("operator_code").startswith("HV"), "fhvhv").otherwise("yellow")
    return fact.groupBy(service.alias("service"), F.col("file_month").cast("string").alias("file_month")).agg(
        F.count(F.lit(1)).alias("trips"), F.min("trip_id").alias("first_id"), F.max("trip_id").alias("last_id"),
        F.countDistinct("trip_id").alias("ids"), F.sum(F.round(F.col("fare_amount").cast("double") * 100).cast("long")).alias("fare_cents"))


def fact_operator_join(fact: DataFrame, operators: DataFrame) -> DataFrame:
    """Trips joined to their operator (inner: unknown codes fall out).

    The operator dimension is a fixed 4-row table, broadcast to every task.
    """
    return fact.join(F.broadcast(operators), "operator_code", "inner")


def orphan_operators(fact: DataFrame, operators: DataFrame) -> DataFrame:
    """Trips whose operator code has no dimension row: what the inner join drops."""
    return (fact.join(F.broadcast(operators.select("operator_code")), "operator_code", "left_anti")
            .groupBy("operator_code").agg(F.count(F.lit(1)).alias("trip_count")))


def service_counts(fact: DataFrame, codes_by_service: dict) -> DataFrame:
    """Trips per service, counting only that service's known operator codes."""
    service = None
    for name, codes in codes_by_service.items():
        cond = F.col("operator_code").isin(list(codes))
        service = F.when(cond, F.lit(name)) if service is None else service.when(cond, F.lit(name))
    return (fact.select(service.alias("service")).filter(F.col("service").isNotNull())
            .groupBy("service").agg(F.count(F.lit(1)).alias("trip_count")))


def operator_share(fact: DataFrame, operators: DataFrame) -> DataFrame:
    """Trips per (category, operator) and their percent of all joined trips.

    Aggregated first (a handful of rows), so the window total runs on the
    tiny result only.
    """
    counts = (fact_operator_join(fact, operators)
              .groupBy("category", "operator_name")
              .agg(F.count(F.lit(1)).alias("total_trip")))
    total = F.sum("total_trip").over(Window.partitionBy())
    return counts.withColumn("persen", round_half_away(F.col("total_trip") * 100.0 / total, 1))
