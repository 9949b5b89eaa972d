"""Incremental cleaning: each landed file is cleaned once, new months are picked up."""

from pyspark.sql import functions as F

from tripdemand import catalog
from tripdemand import fixtures as fx
from tripdemand.session import scratch_path
from tripdemand.sources import trips as src
from tripdemand.streaming.landing import clean_new_files, read_incremental_clean
from tests.conftest import SF_SMALL


def test_clean_new_files_is_incremental(spark):
    root = scratch_path(spark, "stream-landing")
    out = scratch_path(spark, "stream-clean")
    ckpt = scratch_path(spark, "stream-ckpt")
    raw = fx.raw_yellow(spark, SF_SMALL)
    first, last = list(fx.FIXTURE_MONTHS[:2]), fx.FIXTURE_MONTHS[2]

    src.write_trip_files(raw, root, "yellow", first)
    clean_new_files(spark, root, "yellow", out, ckpt)
    got = read_incremental_clean(spark, out, ["yellow"])
    expect = catalog.clean_yellow_df(spark, SF_SMALL)
    assert got.count() == expect.filter(F.col("file_month").isin(first)).count()

    # a second run with nothing new writes nothing
    clean_new_files(spark, root, "yellow", out, ckpt)
    assert read_incremental_clean(spark, out, ["yellow"]).count() == got.count()

    src.write_trip_files(raw, root, "yellow", [last])
    clean_new_files(spark, root, "yellow", out, ckpt)
    final = read_incremental_clean(spark, out, ["yellow"]).select(*expect.columns)
    assert final.exceptAll(expect).count() == 0 and expect.exceptAll(final).count() == 0


def test_stream_reads_wide_integers_like_the_batch(spark):
    root = scratch_path(spark, "stream-wide")
    wide = fx.raw_yellow(spark, SF_SMALL).withColumns({c: F.col(c).cast("long") for c in ("VendorID", "PULocationID", "DOLocationID")})
    src.write_trip_files(wide, root, "yellow", fx.FIXTURE_MONTHS[:1])
    out = scratch_path(spark, "stream-wide-clean")
    clean_new_files(spark, root, "yellow", out, scratch_path(spark, "stream-wide-ckpt"))
    batch = catalog.cleaning.clean_yellow(src.read_trips(spark, root, "yellow", fx.FIXTURE_MONTHS[:1]))
    got = read_incremental_clean(spark, out, ["yellow"]).select(*batch.columns)
    assert got.count() == batch.count() > 0 and got.exceptAll(batch).count() == 0


def test_command_line_batch(spark):
    from tripdemand.cli import main
    from tripdemand.session import scratch_path
    land = fx.landed(spark, SF_SMALL)
    out = scratch_path(spark, "cli-wh")
    main(["--raw", land.trips, "--out", out, "--months", *fx.FIXTURE_MONTHS,
          "--weather", land.weather_payload, "--model-cut", fx.FIXTURE_CUT, "--trees", "3"])
    assert spark.read.parquet(f"{out}/agg_hourly_demand").count() == catalog.agg_hourly_df(spark, SF_SMALL).count()
    assert spark.read.parquet(f"{out}/ml_model_metrics").count() == 1
    assert spark.read.parquet(f"{out}/ml_feature_importance").count() == 16


def test_command_line_append(spark, capsys):
    from tripdemand.cli import main
    from tripdemand.plans.warehouse import read_table
    land = fx.landed(spark, SF_SMALL)
    out = scratch_path(spark, "cli-append")
    given = ["--raw", land.trips, "--out", out, "--weather", land.weather_payload, "--months"]
    main([*given, *fx.FIXTURE_MONTHS[:2]])
    main([*given, *fx.FIXTURE_MONTHS, "--append"])
    main([*given, *fx.FIXTURE_MONTHS, "--append"])
    said = capsys.readouterr().out
    assert f"new months: {fx.FIXTURE_MONTHS[2]}" in said and "new months: none" in said
    assert read_table(spark, out, "agg_hourly_demand").exceptAll(catalog.agg_hourly_df(spark, SF_SMALL)).count() == 0
