"""Inputs that are malformed, missing or emptied must not vanish silently."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripdemand import catalog
from tripdemand import fixtures as fx
from tripdemand.operators import ml
from tripdemand.operators import weather as wx
from tripdemand.plans import warehouse as job
from tripdemand.session import scratch_path
from tripdemand.sources import trips as src


@pytest.mark.parametrize("payload", [
    '{"error": true, "reason": "limit"}', '{"hourly": {"time": ["2024-01-01T00:00"]', "not json",
    '{"hourly": {"time": ["2024-01-01T00:00"], "temperature_2m": [1.0, 2.0]}}', '{"hourly": {"time": ["2024-01-01T00:00"]}}'])
def test_malformed_weather_fails(spark, payload):
    with pytest.raises(Exception, match="(?i)payload|malformed"):
        wx.explode_weather(spark.createDataFrame([(payload,)], "payload string")).collect()


def test_payload_files_of_one_object_or_one_a_line(spark, tmp_path):
    import json

    days = [json.loads(r.payload) for r in wx.weather_payload(catalog.weather_hourly_df(spark, SF_SMALL)).collect()]
    one = {"latitude": 40.7, "hourly": {k: [x for d in days for x in d["hourly"].get(k, [None] * len(d["hourly"]["time"]))] for k in ["time", *(f[0] for f in wx.PAYLOAD_FIELDS)]}}
    texts = {"pretty": json.dumps(one, indent=2), "single": json.dumps(one), "lines": "\n".join(map(json.dumps, days)) + "\n\n"}
    rows = {}
    for name, text in texts.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "payload.json").write_text(text)
        rows[name] = sorted(map(str, wx.explode_weather(wx.read_payloads(spark, str(tmp_path / name)), "value").collect()))
    assert rows["pretty"] == rows["single"] == rows["lines"] and len(rows["lines"]) > 24
    (tmp_path / "lines" / "more.json").write_text(texts["pretty"])  # both kinds in one folder
    assert wx.read_payloads(spark, str(tmp_path / "lines")).count() == len(days) + 1
    (tmp_path / "single" / "broken.json").write_text("{\n\"hourly\": ")
    with pytest.raises(Exception, match="(?i)payload|malformed"):
        wx.explode_weather(wx.read_payloads(spark, str(tmp_path / "single")), "value").collect()


def test_measures_are_averaged_as_they_are(spark):
    import datetime as dt

    hours = spark.createDataFrame([(dt.date(2024, 1, 1), t, p) for t, p in ((12.34, 0.004), (12.34, 0.004), (12.38, 0.052))], "date date, temperature double, precipitation double")
    day = hours.withColumns({"snowfall": F.lit(0.0), "is_rain": F.lit(0), "is_snow": F.lit(0)})
    row = wx.weather_daily(day).first()
    assert row.avg_temp == 12.4 and row.total_precip == 0.1  # 12.353..., 0.06


def test_a_month_emptied_by_a_rerun_is_emptied(spark):
    path = scratch_path(spark, "rewrite")
    clean = catalog.clean_all_df(spark, SF_SMALL)
    src.write_clean(clean, path, fx.FIXTURE_MONTHS)
    gone, *rest = fx.FIXTURE_MONTHS
    src.write_clean(clean.where(F.col("file_month") != gone), path, fx.FIXTURE_MONTHS)
    assert {r.file_month for r in src.read_clean(spark, path, clean.schema).select("file_month").distinct().collect()} == set(rest)


def test_missing_months_stop_the_batch(spark):
    land = fx.landed(spark, SF_SMALL)
    with pytest.raises(FileNotFoundError, match="yellow 1999-01"):
        job.build_warehouse(spark, land.trips, scratch_path(spark, "short"), [*fx.FIXTURE_MONTHS, "1999-01"], catalog.weather_hourly_df(spark, SF_SMALL))
    assert src.landed_months(spark, land.trips, "yellow", ["1999-01", fx.FIXTURE_MONTHS[0]]) == [fx.FIXTURE_MONTHS[0]]


def test_only_requested_months_are_loaded(spark):
    land = fx.landed(spark, SF_SMALL)
    out = scratch_path(spark, "months")
    weather = catalog.weather_hourly_df(spark, SF_SMALL)
    job.build_warehouse(spark, land.trips, out, fx.FIXTURE_MONTHS, weather)
    one = fx.FIXTURE_MONTHS[1]
    paths = job.build_warehouse(spark, land.trips, out, [one], weather)
    assert spark.read.parquet(paths["fact_trips"]).count() == catalog.clean_all_df(spark, SF_SMALL).where(F.col("file_month") == one).count()


def test_an_unreadable_model_is_an_error(spark, tmp_path):
    (tmp_path / "model").mkdir()
    with pytest.raises(Exception):
        ml.load_model(str(tmp_path / "model"))
