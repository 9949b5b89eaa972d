"""Composite jobs: land -> clean -> star schema -> aggregates -> model.

The clean zone is published first, then all tables of the star schema in one commit
(``sources.commits``): a failed batch leaves every table as it was. Each stage reads what
the one before has written, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdemand.operators import aggregates, cleaning, ml, quality, warehouse
from tripdemand.operators import weather as wx
from tripdemand.plans import model
from tripdemand.sources import commits, zones
from tripdemand.sources import trips as src

# column whose values name the folders of a table; not part of its rows
FOLDERS = {"fact_trips": "file_month", "agg_hourly_demand": "month_key", "agg_zone_demand": "month_key"}
TABLES = ("dim_location", "dim_operator", "fact_trips", "agg_hourly_demand", "agg_zone_demand")
#: Which (service, file month) is in the fact, with how many rows and from which id.
LEDGER = "load_ledger"
#: Mergeable sums per hour, zone and operator, in folders by pickup month and file month.
STATE, STATE_FOLDERS = "trip_state", ("month_key", "file_month")


#: Written with the fact: filters that tell which pickup zones a row group cannot hold.
FACT_OPTIONS = {"parquet.bloom.filter.enabled#PULocationID": "true", "parquet.bloom.filter.expected.ndv#PULocationID": "300"}


def by_zone(fact: DataFrame) -> DataFrame:
    """Fact rows in the order they are written in: by pickup zone within each task's file of a month.

    No shuffle. A row group then holds few zones, so a list of zone ids skips most of them.
    """
    return fact.sortWithinPartitions("file_month", "PULocationID")


def clean_months(spark: SparkSession, raw_root: str, months: Sequence[str]) -> DataFrame:
    """Both services' landed files of the months, cleaned; an error if one has not landed."""
    missing = [f"{s} {m}" for s in src.SERVICES for m in sorted(set(months) - set(src.landed_months(spark, raw_root, s, months)))]
    if missing:
        raise FileNotFoundError(f"no landed file for {', '.join(missing)} under {raw_root}")
    return cleaning.union_clean(
        cleaning.clean_yellow(src.read_trips(spark, raw_root, "yellow", months)),
        cleaning.clean_hvfhv(src.read_trips(spark, raw_root, "fhvhv", months)))


def build_warehouse(spark: SparkSession, raw_root: str, out_root: str, months: Sequence[str],
                    weather_hourly: DataFrame, zone_lookup: DataFrame | None = None,
                    model_cut: str | None = None, **model_params) -> dict[str, str]:
    """Run the batch: returns table name -> the folder that now holds it.

    ``zone_lookup`` is the public zone CSV as a DataFrame (``read_zones``);
    without it the built-in 55-zone dimension is used.

    Exactly the requested months are loaded; if a file of one of them has not
    landed, nothing is written. Trips are numbered by their place in the
    written clean files: no sort, no staging copy, one extra count per file.

    With ``model_cut`` the demand model is fitted on the dates before it and its
    tables are written beside the others (``plans.model``).
    """
    out = out_root.rstrip("/")

    # 1. clean both services in one scan each, written per (service, month)
    src.write_clean(clean_months(spark, raw_root, months), f"{out}/clean", months)
    clean = src.read_clean(spark, f"{out}/clean", months=months)

    # 2. dimensions (small, fixed size) and the weather
    change = commits.Change(spark, out)
    change.replace("dim_location", zones.dim_location(zone_lookup) if zone_lookup is not None else zones.builtin_dim_location(spark))
    change.replace("dim_operator", zones.dim_operator(spark))
    change.replace("dim_weather", wx.build_dim_weather(weather_hourly))

    # 3. fact with dense ids, partitioned by landing month, and what was loaded
    change.replace("fact_trips", by_zone(warehouse.fact_of_files(clean, keep=("file_month",))), ["file_month"], **FACT_OPTIONS)
    change.replace(LEDGER, warehouse.ledger_rows(clean))

    # 4. aggregates from the written tables
    change.replace(STATE, _state(change.staged("fact_trips")), STATE_FOLDERS)
    for table, rows in _demand(change, change.staged(STATE)).items():
        change.replace(table, rows, [FOLDERS[table]])
    change.publish()
    paths = {t: commits.table_path(spark, out, t) for t in (*TABLES, "dim_weather")} | {"clean": f"{out}/clean"}

    # 5. the demand model, from the written aggregate
    if model_cut:
        features = ml.build_features(read_table(spark, out, "agg_hourly_demand"))
        paths |= model.build_model(spark, out, features, model_cut, **model_params)
    return paths


def load_fact(spark: SparkSession, out_root: str, clean: DataFrame) -> int:
    """Publish the clean files that the ledger of ``out_root`` does not name as fact rows; returns the first new id.

    The same files again change nothing.
    """
    change = commits.Change(spark, out_root.rstrip("/"))
    first = _append_fact(change, clean)
    change.publish()
    return first


def _append_fact(change: commits.Change, clean: DataFrame) -> int:
    first = 1
    if LEDGER in change.tables:
        ledger = change.staged(LEDGER)
        clean, first = warehouse.not_loaded(clean, ledger), warehouse.next_trip_id(ledger)
    change.append("fact_trips", by_zone(warehouse.fact_of_files(clean, first, keep=("file_month",))), ["file_month"], **FACT_OPTIONS)
    change.append(LEDGER, warehouse.ledger_rows(clean, first))
    return first


def append_months(spark: SparkSession, raw_root: str, out_root: str, months: Sequence[str],
                  weather_hourly: DataFrame | None = None) -> list[str]:
    """Load further months into a built warehouse; returns the months that were new.

    Months that the ledger names for both services are left alone, so a repeated call changes
    nothing, and one after a failure does what is left. New trips are numbered after the
    ledger's last id. Only their files are read: they are added to the fact, their state to
    the states, and the aggregates' folders of the pickup months they touch are made
    again from the states. ``weather_hourly`` adds the hours that the weather does not have yet.
    """
    out = out_root.rstrip("/")
    change = commits.Change(spark, out)
    ledger = read_table(spark, out, LEDGER)
    loaded = {(r.service, r.file_month) for r in ledger.select("service", "file_month").collect()}
    new = [m for m in sorted(set(months)) if not all((s, m) in loaded for s in src.SERVICES)]
    if not new:
        return []
    src.write_clean(clean_months(spark, raw_root, new), f"{out}/clean", new)
    first = _append_fact(change, src.read_clean(spark, f"{out}/clean", months=new))
    if weather_hourly is not None:
        hours = wx.build_dim_weather(weather_hourly)
        known = read_table(spark, out, "dim_weather").select("date", "hour").distinct()
        change.append("dim_weather", hours.join(known, ["date", "hour"], "left_anti").select(*hours.columns))
    added = _state(change.staged("fact_trips").where(F.col("file_month").isin(new) & (F.col("trip_id") >= first)))
    change.append(STATE, added, STATE_FOLDERS)
    # one row per pickup month that the new files touch
    touched = [r[0] for r in change.staged(STATE).where(F.col("file_month").isin(new)).select("month_key").distinct().collect()]
    for table, rows in _demand(change, change.staged(STATE).where(F.col("month_key").isin(touched))).items():
        change.replace_parts(table, rows, [FOLDERS[table]])
    change.publish()
    return new


def _state(fact: DataFrame) -> DataFrame:
    return aggregates.trip_state(fact, ["file_month"]).withColumn("month_key", F.date_format("date", "yyyy-MM"))


def _demand(change: commits.Change, state: DataFrame) -> dict[str, DataFrame]:
    """Both demand tables of some states."""
    ops = change.staged("dim_operator")
    hourly = aggregates.hourly_of_state(state, ops, change.staged("dim_weather"))
    zone = aggregates.zone_of_state(state, ops, change.staged("dim_location"))
    return {"agg_hourly_demand": hourly.withColumn("month_key", F.date_format("date", "yyyy-MM")),
            "agg_zone_demand": zone.withColumn("month_key", F.date_format("month", "yyyy-MM"))}


def read_table(spark: SparkSession, out_root: str, name: str, columns: Sequence[str] | None = None,
               order: Sequence[str] | None = None, months: Sequence[str] | None = None, folder: bool = False) -> DataFrame:
    """A table of a written warehouse: the named columns, in the named order of rows.

    ``months`` (YYYY-MM) prunes whole folders of the tables that have them;
    ``folder`` keeps the column that names the folders.
    """
    df = commits.read_committed(spark, out_root, name)
    key = FOLDERS.get(name)
    if months is not None:
        if key is None:
            raise ValueError(f"{name} has no folders by month")
        df = df.filter(F.col(key).isin(list(months)))
    if key is not None and not folder:
        df = df.drop(key)
    if columns is not None:
        df = df.select(*columns)
    return df if order is None else df.orderBy(*order)


def read_weather(spark: SparkSession, out_root: str, payloads: str) -> DataFrame:
    """``dim_weather`` of a warehouse, or where it was never written, the same rows from the payloads."""
    if commits.has_table(spark, out_root.rstrip("/"), "dim_weather"):
        return read_table(spark, out_root, "dim_weather")
    return wx.build_dim_weather(wx.explode_weather(wx.read_payloads(spark, payloads), "value"))


def warehouse_row_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Row count of each warehouse table (the pipeline's validation step)."""
    return quality.row_counts({t: spark.read.parquet(paths[t]) for t in TABLES})
