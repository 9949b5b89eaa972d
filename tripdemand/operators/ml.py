"""Hourly demand model: features, time split, boosted trees, scoring, metrics.

Training data is the hourly aggregate (rows = date x hour x zone x operator,
bounded by the calendar and the dimensions, not by trip volume). Features are
column expressions; a model is a table of tree nodes (``operators.boosting``),
so fitting and scoring run in the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripdemand.functions import exact_mean, literal_frame, round_half_away, round_half_even
from tripdemand.operators import boosting
from tripdemand.operators.weather import MEASURE_PLACES, WEATHER_DEFAULTS, demand_weather_defaults
from tripdemand.session import checkpoint_dir, path_exists

# --- fixed values (must equal the reference's) --------------------------------
FEATURE_COLS = (
    "hour", "day_of_week", "month", "PULocationID",
    "is_weekend", "category_enc", "operator_enc",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos",
    "temperature", "precipitation", "windspeed", "is_rain", "is_snow",
)
OPERATOR_ENC = (("Creative Mobile Tech", 0), ("VeriFone", 1), ("Uber", 2), ("Lyft", 3))
FEATURE_LABELS = (
    ("hour", "Jam"), ("day_of_week", "Hari dalam Minggu"), ("month", "Bulan"),
    ("PULocationID", "ID Zona Pickup"), ("is_weekend", "Akhir Pekan"),
    ("category_enc", "Kategori"), ("operator_enc", "Operator"),
    ("hour_sin", "Jam (sin)"), ("hour_cos", "Jam (cos)"),
    ("dow_sin", "Hari (sin)"), ("dow_cos", "Hari (cos)"),
    ("temperature", "Suhu (°C)"), ("precipitation", "Curah Hujan (mm)"),
    ("windspeed", "Kecepatan Angin (km/h)"), ("is_rain", "Hujan"), ("is_snow", "Salju"),
)
MODERN_CATEGORY = "Modern"
MODEL_NAME = "boosted_trees"
DEFAULT_PARAMS = dict(n_trees=300, max_depth=6, learning_rate=0.05, subsample=0.8,
                      colsample=0.8, max_bins=256, seed=42)
# scenario weather rules (interactive prediction): rain above 0.1 mm, snow
# when at or below 2 degrees with any precipitation
SCENARIO_RAIN_MM = 0.1
SCENARIO_SNOW_MAX_TEMP = 2.0
# ------------------------------------------------------------------------------

# what tells training rows apart
ROW_KEY = ("date", "hour", "PULocationID", "category", "operator_name")
PREDICTION_KEYS = ("date", "hour", "day_of_week", "PULocationID", "category",
                   "operator_name", "trip_count")


def _cyclic(value: Column, period: int) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * value / F.lit(period)
    return F.sin(angle), F.cos(angle)


def _operator_enc(name: Column) -> Column:
    enc = F.lit(-1)
    for op, code in reversed(OPERATOR_ENC):
        enc = F.when(name == op, F.lit(code)).otherwise(enc)
    return enc


def build_features(df: DataFrame) -> DataFrame:
    """Hourly demand rows with the model's inputs beside their own columns.

    Calendar, category and operator become numbers (an unknown operator -1).
    Where a weather column is missing or null, it has its default.
    """
    hs, hc = _cyclic(F.col("hour"), 24)
    ds, dc = _cyclic(F.col("day_of_week"), 7)
    cols = {
        "month": F.month("date"),
        "is_weekend": F.col("day_of_week").isin(0, 6).cast("int"),
        "hour_sin": hs, "hour_cos": hc, "dow_sin": ds, "dow_cos": dc,
        "category_enc": (F.col("category") == MODERN_CATEGORY).cast("int"),
        "operator_enc": _operator_enc(F.col("operator_name")),
    }
    for name, default in WEATHER_DEFAULTS:
        lit = F.lit(default)
        cols[name] = F.coalesce(F.col(name), lit) if name in df.columns else lit
    return df.withColumns(cols)


def fallback_training_rows(demand: DataFrame, dim_weather: DataFrame) -> DataFrame:
    """Feature rows of the retrain-on-miss path.

    The demand's own weather columns are replaced by the hourly weather
    table's, and hours without weather take the feature defaults, before
    the usual features are derived.
    """
    return build_features(demand_weather_defaults(demand, dim_weather))


def time_split(df: DataFrame, cut: str) -> tuple[DataFrame, DataFrame]:
    """Train: dates before ``cut``; test: ``cut`` and later (no upper bound)."""
    c = F.lit(cut).cast("date")
    return df.filter(F.col("date") < c), df.filter(F.col("date") >= c)


def fit_demand(train: DataFrame, **params) -> DataFrame:
    """The nodes of trees fitted on feature rows (label ``trip_count``), computed and kept in the checkpoint folder.

    Equal rows give equal trees, however they are partitioned (``operators.boosting``).
    """
    checkpoint_dir(train.sparkSession)
    return boosting.fit_trees(train, ROW_KEY, FEATURE_COLS, "trip_count", **{**DEFAULT_PARAMS, **params}).checkpoint()


def clipped(prediction: Column) -> Column:
    return F.greatest(F.lit(0.0), prediction)


def predict_demand(model: DataFrame, test: DataFrame) -> DataFrame:
    """Score rows; keep the unrounded clipped value for metrics, store 0.1-rounded."""
    rows = test.select(*dict.fromkeys([*PREDICTION_KEYS, *FEATURE_COLS]))
    scored = boosting.score_trees(rows, model)
    return scored.select(*PREDICTION_KEYS,
                         clipped(F.col("prediction")).alias("prediction_clipped"),
                         round_half_even(clipped(F.col("prediction")), 1).alias("predicted"))


def regression_metrics(pred: DataFrame, label: str = "trip_count",
                       prediction: str = "prediction_clipped", model_name: str = MODEL_NAME,
                       train_rows: Column | int | None = None) -> DataFrame:
    """RMSE, MAE and R^2 (4 places) plus row counts, in one aggregation pass.

    The label is a count, so its first and second moments are exact integer
    sums and the total sum of squares needs no second pass:
    SST = sum(y^2) - sum(y)^2 / n. A constant label (SST = 0) scores R^2 = 1
    for a perfect fit and 0 otherwise, the usual finite convention.
    """
    y, p = F.col(label), F.col(prediction).cast("double")
    err = y.cast("double") - p
    m = pred.agg(F.count(F.lit(1)).alias("n"),
                 F.sum(y.cast("long")).alias("sy"),
                 F.sum(y.cast("long") * y.cast("long")).alias("syy"),
                 F.sum(err * err).alias("sse"),
                 F.sum(F.abs(err)).alias("sae"))
    sst = F.col("syy").cast("double") - F.col("sy").cast("double") * F.col("sy").cast("double") / F.col("n")
    train = train_rows if isinstance(train_rows, Column) else F.lit(train_rows)
    return m.select(
        F.lit(model_name).alias("model_name"),
        round_half_away(F.sqrt(F.col("sse") / F.col("n")), 4).alias("rmse"),
        round_half_away(F.col("sae") / F.col("n"), 4).alias("mae"),
        round_half_away(F.when(sst == 0, F.when(F.col("sse") == 0, 1.0).otherwise(0.0))
                        .otherwise(F.lit(1.0) - F.col("sse") / sst), 4).alias("r2"),
        train.cast("long").alias("train_rows"),
        F.col("n").cast("long").alias("test_rows"),
    )


def feature_importance(model: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Each feature's share of the mean gains of splits, largest first, with display labels.

    The node table is bounded by the trees; features that never split have share 0.
    """
    labels = literal_frame(spark or model.sparkSession, [(i, f, label) for i, (f, label) in enumerate(FEATURE_LABELS)], "place int, feature string, label string")
    mean = F.coalesce("gain", F.lit(0.0))
    # one row for each feature; summed in their order
    whole = F.sum(mean).over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    shares = labels.join(boosting.gains(model), "feature", "left").withColumn("importance", F.when(whole > 0, mean / whole).otherwise(0.0))
    return shares.select("feature", "importance", "label").orderBy(F.col("importance").desc(), "feature")


def save_model(model: DataFrame, path: str) -> None:
    model.write.mode("overwrite").parquet(path)


def load_model(path: str) -> DataFrame | None:
    """Load saved nodes; ``None`` when there are none. A model that cannot be read is an error."""
    spark = SparkSession.getActiveSession()
    if not path_exists(spark, path):
        return None
    nodes = spark.read.parquet(path)
    if missing := {c.split()[0] for c in boosting.NODES.split(", ")} - set(nodes.columns):
        raise ValueError(f"{path} holds no model: {', '.join(sorted(missing))} missing")
    return nodes


def load_or_train(path: str, train: DataFrame, **params) -> DataFrame:
    """Reuse the saved model, or fit and save one when it is absent."""
    model = load_model(path)
    if model is None:
        model = fit_demand(train, **params)
        save_model(model, path)
    return model


def scenario_inputs(demand: DataFrame, dim_weather: DataFrame, cut: str) -> DataFrame:
    """What-if inputs: each (date, zone, category, operator) of the test period
    with that day's mean weather.

    One scenario per observed combination, so the grid grows with the data;
    the weather is the day's mean temperature, precipitation and wind.
    """
    day_weather = dim_weather.groupBy("date").agg(
        round_half_even(exact_mean(F.col("temperature"), MEASURE_PLACES), 1).alias("temperature"),
        round_half_even(exact_mean(F.col("precipitation"), MEASURE_PLACES), 2).alias("precipitation"),
        round_half_even(exact_mean(F.col("windspeed"), MEASURE_PLACES), 1).alias("windspeed"))
    scen = (demand.filter(F.col("date") >= F.lit(cut).cast("date"))
            .select("date", "PULocationID", "category", "operator_name").distinct())
    return scen.join(day_weather, "date", "left").na.fill(
        {c: v for c, v in WEATHER_DEFAULTS if c in day_weather.columns})


def scenario_grid(scenarios: DataFrame) -> DataFrame:
    """Scenario rows -> model features.

    A scenario has a date, or else day_of_week and month, and may name its hour;
    without one it expands to all 24 hours with a generator (no join). Rain and
    snow follow the interactive rules (snow: cold and any precipitation).
    """
    hs, hc = _cyclic(F.col("hour"), 24)
    ds, dc = _cyclic(F.col("day_of_week"), 7)
    base, dated = scenarios, "date" in scenarios.columns
    if dated:
        base = (base.withColumn("day_of_week", (F.dayofweek("date") - 1).cast("int"))
                .withColumn("month", F.month("date")))
    if "hour" not in base.columns:
        base = base.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    return base.select(
        *(["date"] if dated else []), "PULocationID", "category", "operator_name",
        "hour", "day_of_week", "month",
        F.col("day_of_week").isin(0, 6).cast("int").alias("is_weekend"),
        (F.col("category") == MODERN_CATEGORY).cast("int").alias("category_enc"),
        _operator_enc(F.col("operator_name")).alias("operator_enc"),
        hs.alias("hour_sin"), hc.alias("hour_cos"), ds.alias("dow_sin"), dc.alias("dow_cos"),
        "temperature", "precipitation", "windspeed",
        (F.col("precipitation") > SCENARIO_RAIN_MM).cast("int").alias("is_rain"),
        ((F.col("temperature") <= SCENARIO_SNOW_MAX_TEMP) & (F.col("precipitation") > 0.0))
        .cast("int").alias("is_snow"),
    )


def score_scenarios(model: DataFrame, grid: DataFrame, rounded: bool = True) -> DataFrame:
    """Predicted trips per scenario hour, clipped at zero; to 0.1 unless ``rounded`` is off."""
    keys = ["date"] if "date" in grid.columns else ["day_of_week", "month"]
    value = clipped(F.col("prediction"))
    return boosting.score_trees(grid, model).select(*keys, "PULocationID", "category", "operator_name", "hour",
                                        (round_half_even(value, 1) if rounded else value).alias("predicted"))


def baseline_predictions(train: DataFrame, test: DataFrame,
                         overall_mean: float | None = None) -> DataFrame:
    """Deterministic reference predictor: historical mean per (zone, hour, operator).

    Combinations unseen in training fall back to the overall training mean.
    Used to check the metric and report operators against SQL, and as the
    bar a fitted model should clear.
    """
    hist = train.groupBy("PULocationID", "hour", "operator_name").agg(
        F.avg(F.col("trip_count").cast("double")).alias("_hist"))
    # one scalar: the overall training mean (pass it in if already known)
    overall = overall_mean
    if overall is None:
        overall = train.agg(F.avg(F.col("trip_count").cast("double"))).first()[0]
    scored = test.join(hist, ["PULocationID", "hour", "operator_name"], "left")
    p = F.coalesce(F.col("_hist"), F.lit(overall).cast("double"))
    return scored.select(*PREDICTION_KEYS,
                         clipped(p).alias("prediction_clipped"),
                         round_half_even(clipped(p), 1).alias("predicted"))
