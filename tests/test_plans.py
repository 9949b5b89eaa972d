"""Plan checks: broadcasts where sizes are fixed, pushdown, no Python in plans."""

import contextlib
import io

import pytest

from tripdemand import catalog
from tripdemand import fixtures as fx
from tripdemand.operators import cleaning, warehouse
from tripdemand.session import path_exists, scratch_path
from tripdemand.sources import trips as src
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_no_python_in_query_plans(spark, key):
    plan = _plan(catalog.QUERIES[key](spark, SF_SMALL))
    for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                   "MapInPandas"):
        assert marker not in plan, f"{key}: {marker}"


def test_dimension_joins_are_broadcast(spark):
    plan = _plan(catalog.QUERIES["agg_zone_demand"](spark, SF_SMALL))
    assert plan.count("BroadcastHashJoin") >= 2
    assert "SortMergeJoin" not in plan


def test_aggregate_is_partial_before_the_shuffle(spark):
    df = catalog.QUERIES["agg_hourly_demand"](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    plan = _plan(df)
    assert "partial_count" in plan


def test_clean_filters_reach_the_parquet_scan(spark):
    root = scratch_path(spark, "landing-test")
    src.write_trip_files(fx.raw_yellow(spark, SF_SMALL), root, "yellow", fx.FIXTURE_MONTHS)
    df = cleaning.clean_yellow(src.read_trips(spark, root, "yellow", fx.FIXTURE_MONTHS))
    plan = _formatted(df)
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters")]
    assert pushed and "GreaterThan(fare_amount,0.0)" in pushed[0]
    assert "GreaterThan(trip_distance,0.0)" in pushed[0] and "LessThan(trip_distance,100.0)" in pushed[0]
    assert df.count() == catalog.clean_yellow_df(spark, SF_SMALL).count()
    # file-month filter prunes files: only the requested month's folder is read
    one = src.read_trips(spark, root, "yellow", ["2024-02"])
    assert {r[0] for r in one.select("file_month").distinct().collect()} == {"2024-02"}
    assert path_exists(spark, f"{root}/yellow_tripdata_2024-02.parquet")


def test_trip_ids_use_no_unpartitioned_window_over_trips(spark):
    files = src.read_clean(spark, f"{catalog.warehouse_root(spark, SF_SMALL)}/clean", catalog.clean_all_df(spark, SF_SMALL).schema)
    plan = _plan(warehouse.fact_of_files(files))
    # the only Window runs over one row per file, on one side of the join; the trips are never windowed
    assert plan.count("Window") == 1
    assert "rangepartitioning(pickup" not in plan


@pytest.mark.parametrize("key", ["fact_trips", "trip_id", "fact_append", "sample_rows", "fact_operator_join"])
def test_fact_keys_sort_no_trips(spark, key):
    assert "rangepartitioning" not in _plan(catalog.QUERIES[key](spark, SF_SMALL))


def test_months_are_found_without_reading_trips(spark):
    plan = _formatted(catalog.QUERIES["missing_months"](spark, SF_SMALL))
    assert "binaryFile" in plan and "Scan parquet" not in plan
    root = fx.landed(spark, SF_SMALL).trips
    used = _plan(src.read_trips(spark, root, "yellow").select("fare_amount"))
    assert "regexp_extract" not in used


def test_month_request_prunes_files_at_listing(spark):
    root = fx.landed(spark, SF_SMALL).trips
    one = src.read_trips(spark, root, "yellow", ["2024-02"])
    assert one.inputFiles() and all("yellow_tripdata_2024-02.parquet" in f for f in one.inputFiles())
    none = src.read_trips(spark, root, "yellow", ["2030-01"])
    assert none.count() == 0 and "file_month" in none.columns
    both = src.read_trips(spark, root, "yellow", ["2024-02", "2030-01"])
    assert both.count() == one.count()


def test_both_integer_widths_of_ids_are_read(spark):
    root = scratch_path(spark, "wide-ids")
    raw = fx.raw_yellow(spark, SF_SMALL).filter("file_month = '2024-01'")
    wide = raw.withColumns({c: raw[c].cast("long") for c in ("VendorID", "PULocationID", "DOLocationID")})
    src.write_trip_files(wide, root, "yellow", ["2024-01"])
    got = src.read_trips(spark, root, "yellow", ["2024-01"])
    assert dict(got.dtypes)["PULocationID"] == "int"
    assert got.exceptAll(raw.select(*got.columns)).count() == 0 and got.count() == raw.count()


def test_warehouse_tables_read_by_column_order_and_month(spark):
    from tripdemand.plans import warehouse as job
    root = catalog.warehouse_root(spark, SF_SMALL)
    zone = job.read_table(spark, root, "agg_zone_demand", ["month", "trip_count"], ["month"], months=["2024-02"])
    assert zone.columns == ["month", "trip_count"] and {r.month.month for r in zone.collect()} == {2}
    assert job.read_table(spark, root, "agg_zone_demand").columns[0] == "month"
    payloads = fx.landed(spark, SF_SMALL).weather_payload
    fallback = job.read_weather(spark, scratch_path(spark, "no-warehouse"), payloads)
    assert fallback.exceptAll(job.read_weather(spark, root, payloads)).count() == 0
