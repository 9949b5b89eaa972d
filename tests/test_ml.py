"""Demand model: a short ensemble fits, scores, beats the mean, and round-trips."""

import datetime as dt

from pyspark.sql import functions as F

from tripdemand import catalog
from tripdemand.operators import ml
from tripdemand.session import scratch_path
from tests.conftest import SF_MID


def test_features_edge_values(spark):
    df = spark.createDataFrame(
        [(dt.date(2026, 1, 4), 0, 0, "Modern", "Uber"), (dt.date(2026, 1, 3), 6, 6, "Konvensional", "Other")],
        "date date, hour int, day_of_week int, category string, operator_name string")
    rows = {r.day_of_week: r for r in ml.build_features(df).collect()}
    assert rows[0].is_weekend == 1 and rows[6].is_weekend == 1
    assert rows[0].operator_enc == 2 and rows[6].operator_enc == -1
    assert rows[0].category_enc == 1 and rows[6].category_enc == 0
    assert rows[0].temperature == 15.0 and rows[0].windspeed == 10.0 and rows[0].is_rain == 0
    assert rows[0].month == 1 and rows[0].hour_sin == 0.0 and rows[0].hour_cos == 1.0


def test_time_split_cut_day_goes_to_test(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),), (dt.date(2024, 3, 1),)], "date date")
    train, test = ml.time_split(df, "2024-03-01")
    assert [r.date for r in train.collect()] == [dt.date(2024, 2, 29)]
    assert [r.date for r in test.collect()] == [dt.date(2024, 3, 1)]


def test_clip_negative_prediction(spark):
    out = spark.range(1).select(ml.clipped(F.lit(-0.3)).alias("p")).first().p
    assert out == 0.0


def test_fit_predict_metrics_and_roundtrip(spark):
    train, test = catalog.split_df(spark, SF_MID)
    model = ml.fit_demand(train, n_trees=10)
    pred = ml.predict_demand(model, test).cache()
    assert pred.count() == test.count() > 0
    assert pred.filter(F.col("predicted") < 0).count() == 0
    m = ml.regression_metrics(pred, train_rows=train.count()).first()
    # demand varies from one trip to hundreds: better than predicting nothing
    # even after ten of the trees (``model_metrics`` compares the whole ensemble)
    zero = ml.regression_metrics(test.select("trip_count", F.lit(0.0).alias("prediction_clipped"))).first()
    assert m.rmse < zero.rmse
    assert m.train_rows == train.count() and m.test_rows == test.count()
    path = scratch_path(spark, "model-test")
    ml.save_model(model, path)
    again = ml.predict_demand(ml.load_model(path), test)
    assert again.exceptAll(pred.select(*again.columns)).count() == 0
    fi = ml.feature_importance(model, spark).collect()
    assert len(fi) == 16 and abs(sum(r.importance for r in fi) - 1.0) < 1e-6
    assert ml.load_model(scratch_path(spark, "absent")) is None


def test_scenario_grid_has_24_hours_and_snow_rule(spark):
    scen = spark.createDataFrame(
        [(dt.date(2024, 3, 4), 161, "Modern", "Uber", 1.5, 0.2, 10.0),
         (dt.date(2024, 3, 4), 162, "Konvensional", "VeriFone", 5.0, 0.0, 10.0)],
        "date date, PULocationID int, category string, operator_name string, "
        "temperature double, precipitation double, windspeed double")
    grid = ml.scenario_grid(scen)
    assert grid.count() == 48
    snow = {r.PULocationID: (r.is_snow, r.is_rain) for r in grid.select("PULocationID", "is_snow", "is_rain").distinct().collect()}
    assert snow == {161: (1, 1), 162: (0, 0)}


def test_fallback_training_rows_fill_weather_defaults(spark):
    from tests.conftest import SF_SMALL
    agg = catalog.agg_hourly_df(spark, SF_SMALL)
    rows = ml.fallback_training_rows(agg, catalog.dim_weather_df(spark, SF_SMALL))
    assert rows.count() == agg.count()
    nulls = rows.select([F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in ml.FEATURE_COLS]).first()
    assert all(v == 0 for v in nulls)
    assert rows.filter((F.col("temperature") == 15.0) & (F.col("windspeed") == 10.0)).count() > 0


def test_scenarios_by_weekday_month_and_hour(spark):
    scen = spark.createDataFrame([(0, 3, 161, "Modern", "Uber", 1.5, 0.2, 10.0)],
                                 "day_of_week int, month int, PULocationID int, category string, operator_name string, "
                                 "temperature double, precipitation double, windspeed double")
    grid = ml.scenario_grid(scen)
    assert grid.count() == 24 and "date" not in grid.columns
    one = ml.scenario_grid(scen.withColumn("hour", F.lit(7))).collect()
    assert [(r.hour, r.month, r.is_weekend, r.is_snow) for r in one] == [(7, 3, 1, 1)]


def test_artifacts_are_made_again_when_any_is_missing(spark):
    from tests.conftest import SF_SMALL
    from tripdemand import fixtures as fx
    from tripdemand.plans import model as model_job
    demand, weather = catalog.agg_hourly_df(spark, SF_SMALL), catalog.dim_weather_df(spark, SF_SMALL)
    root = scratch_path(spark, "artifacts")
    assert model_job.load_artifacts(spark, root) is None
    made = model_job.load_or_build(spark, root, demand, weather, fx.FIXTURE_CUT, n_trees=2)
    assert made["ml_demand_predictions"].columns == [*ml.PREDICTION_KEYS, "predicted"]
    assert made["ml_feature_importance"].columns == ["feature", "importance"]
    # an empty part counts as missing
    made["ml_model_metrics"].limit(0).write.mode("overwrite").parquet(f"{root}/ml_model_metrics_empty")
    assert model_job.load_artifacts(spark, root) is not None
    spark.read.parquet(f"{root}/ml_model_metrics_empty").write.mode("overwrite").parquet(f"{root}/ml_model_metrics")
    assert model_job.load_artifacts(spark, root) is None
    again = model_job.load_or_build(spark, root, demand, weather, fx.FIXTURE_CUT, n_trees=2)
    assert again["ml_model_metrics"].count() == 1
