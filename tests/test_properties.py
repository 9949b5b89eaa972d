
import numpy as np
from pyspark.sql import functions as F

from tripdemand import catalog
from tripdemand import fixtures as fx
from tripdemand.functions import round_half_away
from tripdemand.operators import aggregates, cleaning, quality, reports, warehouse
from tripdemand.sources import trips as src
from tripdemand.sources import zones
from tests.conftest import SF_SMALL


def test_trip_ids_are_exactly_one_to_n_in_load_order(spark):
    clean = src.read_clean(spark, f"{catalog.warehouse_root(spark, SF_SMALL)}/clean")
    fact = warehouse.fact_of_files(clean, keep=("file_month",))
    n = clean.count()
    stats = fact.agg(F.min("trip_id"), F.max("trip_id"), F.countDistinct("trip_id")).first()
    assert tuple(stats) == (1, n, n)
    # yellow before fhvhv, months ascending
    per = fact.groupBy(F.col("operator_code").isin("1", "2", "6").alias("y"), "file_month").agg(
        F.min("trip_id").alias("lo"), F.max("trip_id").alias("hi")).orderBy("lo").collect()
    assert [r.y for r in per] == [True, True, True, False, False, False]
    assert all(a.hi + 1 == b.lo for a, b in zip(per, per[1:]))


def test_hourly_trip_counts_sum_to_joined_fact_rows(spark):
    fact = catalog.fact_rows_df(spark, SF_SMALL)
    ops = zones.dim_operator(spark)
    agg = catalog.agg_hourly_df(spark, SF_SMALL)
    total = agg.agg(F.sum("trip_count")).first()[0]
    assert total == warehouse.fact_operator_join(fact, ops).count()
    orphans = warehouse.orphan_operators(fact, ops).collect()
    assert [r.operator_code for r in orphans] == ["6"]
    assert total + orphans[0].trip_count == fact.count()


def test_aggregate_then_join_equals_join_then_aggregate(spark):
    fact = catalog.fact_rows_df(spark, SF_SMALL)
    ops = zones.dim_operator(spark)
    w = catalog.dim_weather_df(spark, SF_SMALL)
    p = F.col("pickup_datetime")
    naive = (fact.join(ops, "operator_code")
             .join(w, (F.to_date(p) == w.date) & (F.hour(p) == w.hour), "left")
             .groupBy(F.to_date(p).alias("date"), F.hour(p).alias("hour"), "PULocationID", "operator_id")
             .agg(F.count(F.lit(1)).alias("trip_count"),
                  round_half_away(F.avg("fare_amount"), 2).alias("avg_fare"),
                  round_half_away(F.avg(F.coalesce(w.temperature, F.lit(0.0))), 1).alias("temperature"),
                  F.max(F.coalesce(w.is_rain, F.lit(0))).alias("is_rain")))
    ours = aggregates.agg_hourly_demand(fact, ops, w).select(
        "date", "hour", "PULocationID", "operator_id", "trip_count", "avg_fare", "temperature", "is_rain")
    assert naive.exceptAll(ours).count() == 0 and ours.exceptAll(naive).count() == 0


def test_duplicate_weather_rows_repeat_trips_like_a_join(spark):
    fact = catalog.fact_rows_df(spark, SF_SMALL)
    ops = zones.dim_operator(spark)
    w = catalog.dim_weather_df(spark, SF_SMALL)
    doubled = w.unionByName(w.limit(5))
    base = aggregates.agg_hourly_demand(fact, ops, w).agg(F.sum("trip_count")).first()[0]
    dup = aggregates.agg_hourly_demand(fact, ops, doubled).agg(F.sum("trip_count")).first()[0]
    keys = doubled.groupBy("date", "hour").count().filter("count > 1")
    extra = (fact.join(ops, "operator_code")
             .join(keys, (F.to_date("pickup_datetime") == keys.date)
                   & (F.hour("pickup_datetime") == keys.hour)).count())
    assert dup == base + extra


def test_market_share_sums_to_100(spark):
    prof = catalog.zone_profile_df(spark, SF_SMALL)
    total = reports.market_share(prof).agg(F.sum("percent")).first()[0]
    assert abs(total - 100.0) < 1e-9


def test_top_zones_groups_shared_names(spark):
    prof = catalog.zone_profile_df(spark, SF_SMALL)
    name = "Governor's Island/Ellis Island/Liberty Island"
    zmap = reports.zone_map(prof, "Konvensional").filter(F.col("zone_name") == name)
    top = reports.top_zones(prof, 60).filter(
        (F.col("zone_name") == name) & (F.col("category") == "Konvensional"))
    assert top.count() <= 1
    if zmap.count():
        assert top.first().trip_count == zmap.agg(F.sum("trip_count")).first()[0]


def test_weather_gap_zero_in_aggregate_defaults_in_fallback(spark):
    agg = catalog.agg_hourly_df(spark, SF_SMALL)
    w = catalog.dim_weather_df(spark, SF_SMALL)
    gaps = agg.join(w.select("date", "hour"), ["date", "hour"], "left_anti")
    assert gaps.count() > 0
    g = gaps.agg(F.max(F.abs("temperature")), F.max("windspeed"), F.max("is_rain")).first()
    assert tuple(g) == (0.0, 0.0, 0)
    from tripdemand.operators.weather import demand_weather_defaults
    filled = demand_weather_defaults(gaps, w).select("temperature", "precipitation", "windspeed",
                                                     "is_rain", "is_snow").distinct().collect()
    assert [tuple(r) for r in filled] == [(15.0, 0.0, 10.0, 0, 0)]


def test_null_precipitation_gives_no_rain_and_zero(spark):
    hourly = fx.weather_hourly(spark, SF_SMALL)
    from tripdemand.operators.weather import build_dim_weather
    d = build_dim_weather(hourly.filter(F.col("precipitation").isNull()))
    rows = d.select("precipitation", "is_rain").distinct().collect()
    assert [tuple(r) for r in rows] in ([], [(0.0, 0)])


def test_weather_payload_round_trip(spark):
    from tripdemand.operators.weather import explode_weather, weather_payload
    hourly = fx.weather_hourly(spark, SF_SMALL)
    back = explode_weather(weather_payload(hourly))
    assert back.exceptAll(hourly).count() == 0 and hourly.exceptAll(back).count() == 0


def test_profile_quartiles_match_exact_order_statistics(spark):
    df = spark.range(0, 1001).select((F.col("id") % 37).cast("double").alias("x"),
                                     F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.col("id") * 0.5).alias("y"))
    got = {r.column: r for r in quality.profile(df).collect()}
    for c in ("x", "y"):
        vals = sorted(v[0] for v in df.select(c).collect())
        n = len(vals)
        assert n == got[c]["count"]
        for name, q in quality.QUARTILES:
            # pandas describe() uses NumPy's linear percentile
            assert getattr(got[c], name) == float(np.percentile(vals, q * 100))


def test_clean_keeps_every_operator_code(spark):
    codes = {r[0] for r in catalog.clean_all_df(spark, SF_SMALL).select("operator_code").distinct().collect()}
    assert codes == {"1", "2", "6", "HV0003", "HV0005"}


def test_missing_values_and_schema_report_cover_all_columns(spark):
    raw = fx.raw_yellow(spark, SF_SMALL)
    mv = {r.column: r.missing for r in quality.missing_values(raw).collect()}
    assert mv["Airport_fee"] == raw.count() and mv["VendorID"] == 0
    sr = [r.column for r in quality.schema_report(raw).orderBy("position").collect()]
    assert sr == raw.columns


def test_clean_rule_helpers_match_cleaner(spark):
    raw = fx.raw_fhvhv(spark, SF_SMALL)
    rep = {r.rule: r for r in cleaning.reject_reasons(raw, "fhvhv").collect()}
    assert rep["kept"].failed_rows == cleaning.clean_hvfhv(raw).count()


def test_report_bundle_sections(spark):
    from tripdemand.plans.reports import release, report_bundle
    b = report_bundle(catalog.agg_zone_df(spark, SF_SMALL), catalog.agg_hourly_df(spark, SF_SMALL),
                      month="2024-02-01", category="Modern", trend_window=fx.FIXTURE_TREND)
    try:
        assert b["kpis"].count() == 1
        assert b["market_share"].count() == 1
        assert b["demand_heatmap"].count() <= 7
        assert {r.category for r in b["top_zones"].collect()} == {"Modern"}
    finally:
        release(b)


def test_read_zones_nulls_and_dimension(spark, tmp_path):
    from tripdemand.sources.zones import ZONE_ROWS, dim_location, read_zones
    lines = ['"LocationID","Borough","Zone","service_zone"', '1,"EWR","Newark Airport","EWR"']
    lines += [f'{i},"{b}","{n}","{z}"' for i, n, b, z in ZONE_ROWS]
    lines += ['264,"Unknown","N/A","N/A"', '265,"N/A","Outside of NYC","N/A"']
    path = tmp_path / "zones.csv"
    path.write_text("\n".join(lines) + "\n")
    zl = read_zones(spark, str(path))
    r264 = zl.filter("LocationID = 264").first()
    assert r264.Zone is None and r264.service_zone is None and r264.Borough == "Unknown"
    dim = dim_location(zl)
    assert dim.count() == 55
    assert dim.filter(F.col("location_id").isin(103, 104, 105)).select("zone_name").distinct().count() == 1


def test_ledger_says_what_is_loaded_and_the_next_id(spark):
    clean = src.read_clean(spark, f"{catalog.warehouse_root(spark, SF_SMALL)}/clean")
    yellow = clean.where("service = 'yellow'")
    n = yellow.count()
    ledger = warehouse.ledger_rows(yellow)
    assert warehouse.next_trip_id(ledger) == n + 1
    assert warehouse.next_trip_id(ledger.limit(0)) == 1
    rest = warehouse.not_loaded(clean, ledger)
    assert {r.service for r in rest.select("service").distinct().collect()} == {"fhvhv"}
    more = warehouse.fact_of_files(rest, n + 1, keep=("service", "file_month"))
    first = {(r.service, r.file_month): (r.a, r.n) for r in more.groupBy("service", "file_month").agg(F.min("trip_id").alias("a"), F.count(F.lit(1)).alias("n")).collect()}
    assert first == {(r.service, r.file_month): (r.first_id, r.row_count) for r in warehouse.ledger_rows(rest, n + 1).collect()}
    assert min(a for a, _ in first.values()) == n + 1


def test_file_row_ids_without_sort_or_checkpoint(spark):
    from tripdemand.session import scratch_path
    path = scratch_path(spark, "file-ids")
    src.write_clean(catalog.clean_all_df(spark, SF_SMALL).repartition(3), path)
    clean = src.read_clean(spark, path, catalog.clean_all_df(spark, SF_SMALL).schema)
    fact = warehouse.fact_of_files(clean, keep=("service", "file_month"))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" not in plan and "rangepartitioning" not in plan.lower()
    n = clean.count()
    assert tuple(fact.agg(F.min("trip_id"), F.max("trip_id"), F.countDistinct("trip_id")).first()) == (1, n, n)
    # the same rows get the same ids when computed again
    assert fact.select("trip_id", "pickup_datetime").exceptAll(
        warehouse.fact_of_files(clean).select("trip_id", "pickup_datetime")).count() == 0
    # yellow before the other service, months in stretches that follow each other
    spans = fact.groupBy("service", "file_month").agg(F.min("trip_id").alias("a"), F.max("trip_id").alias("b"), F.count(F.lit(1)).alias("n")).collect()
    spans = sorted(spans, key=lambda r: (r.service != "yellow", r.file_month))
    assert [r.a for r in spans] == [1, *(r.b + 1 for r in spans[:-1])] and all(r.b - r.a + 1 == r.n for r in spans)


def test_warehouse_matches_row_counts(spark):
    from tripdemand.plans import warehouse as job
    from tripdemand.session import scratch_path
    land = fx.landed(spark, SF_SMALL)
    paths = job.build_warehouse(spark, land.trips, scratch_path(spark, "wh-scan"), fx.FIXTURE_MONTHS,
                                catalog.weather_hourly_df(spark, SF_SMALL))
    counts = {r.table: r.row_count for r in job.warehouse_row_counts(spark, paths).collect()}
    assert counts["fact_trips"] == catalog.clean_all_df(spark, SF_SMALL).count()
    assert counts["agg_hourly_demand"] == catalog.agg_hourly_df(spark, SF_SMALL).count()
    fact = spark.read.parquet(paths["fact_trips"])
    assert fact.agg(F.countDistinct("trip_id"), F.max("trip_id")).first() == (counts["fact_trips"],) * 2


def test_display_order_at_the_edge(spark):
    from tripdemand.plans.reports import for_display, release, report_bundle
    b = report_bundle(catalog.agg_zone_df(spark, SF_SMALL), catalog.agg_hourly_df(spark, SF_SMALL))
    try:
        shown = for_display(b)
        counts = [r.trip_count for r in shown["zone_profile"].collect()]
        assert counts == sorted(counts, reverse=True)
        rows = [r.row_order for r in shown["demand_heatmap"].collect()]
        assert rows == sorted(rows)
    finally:
        release(b)
