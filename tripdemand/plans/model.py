"""The model stage of the batch: the fitted model and the three tables made from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripdemand.operators import ml
from tripdemand.sources import commits

MODEL = "model"
PREDICTIONS, IMPORTANCE, METRICS = "ml_demand_predictions", "ml_feature_importance", "ml_model_metrics"
TABLES = (PREDICTIONS, IMPORTANCE, METRICS)


def build_model(spark: SparkSession, out_root: str, features: DataFrame, cut: str,
                model: DataFrame | None = None, **params) -> dict[str, str]:
    """Fit on the dates before ``cut`` and publish the model and its tables in one commit; returns name -> folder.

    Predictions have the seven key columns and ``predicted``, importances the feature and
    its share. A fitted ``model`` may be given instead of fitting one.
    """
    out = out_root.rstrip("/")
    train, test = ml.time_split(features, cut)
    fitted = ml.fit_demand(train, **params) if model is None else model
    change = commits.Change(spark, out)
    change.replace(MODEL, fitted)
    pred = ml.predict_demand(fitted, test)
    change.replace(PREDICTIONS, pred.drop("prediction_clipped"))
    change.replace(IMPORTANCE, ml.feature_importance(fitted).drop("label"))
    change.replace(METRICS, ml.regression_metrics(pred, train_rows=train.count()))
    change.publish()
    return {name: commits.table_path(spark, out, name) for name in (MODEL, *TABLES)}


def load_artifacts(spark: SparkSession, out_root: str) -> dict[str, DataFrame] | None:
    """The model and its tables, all of one commit; ``None`` if any of them is absent or empty. Unreadable ones are an error."""
    out = out_root.rstrip("/")
    if not commits.intact(spark, out, (MODEL, *TABLES)):
        return None
    found = {name: commits.read_committed(spark, out, name) for name in (MODEL, *TABLES)}
    return None if any(t.isEmpty() for t in found.values()) else found


def load_or_build(spark: SparkSession, out_root: str, demand: DataFrame, dim_weather: DataFrame, cut: str, **params) -> dict[str, DataFrame]:
    """The four artifacts; where one is missing all are made again from demand and hourly weather."""
    found = load_artifacts(spark, out_root)
    if found is None:
        build_model(spark, out_root, ml.fallback_training_rows(demand, dim_weather), cut, **params)
        found = load_artifacts(spark, out_root)
        if found is None:
            raise RuntimeError(f"no demand on or after {cut}: the model has nothing to predict")
    return found
