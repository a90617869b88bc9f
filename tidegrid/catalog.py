"""Registered queries: each operator applied to tables of the given data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidegrid.functions.labels import alias_status
from tidegrid.grid import Grid, named
from tidegrid.operators import drift, experiments, forecasting, models, quality, registry, scoring, window_linear
from tidegrid.operators.encoding import encode, fit_encoding
from tidegrid.operators.features import (
    aqi_tier,
    calendar_columns,
    cyclical_columns,
    feature_table,
    history_features,
)
from tidegrid.operators.gaps import fill_seasonal, interpolate
from tidegrid.operators.naming import drop_columns, normalize_columns, resolve_target
from tidegrid.operators.regrid import duplicate_timestamps, numeric_columns, parse_time, regrid
from tidegrid.operators.scaling import (
    minmax_fit,
    minmax_inverse,
    minmax_scale,
    minmax_unscale,
    read_bounds,
    select_features,
)
from tidegrid.operators.sequences import sequence_windows
from tidegrid.operators.splitting import cv_folds, time_split
from tidegrid.plans import batches
from tidegrid.plans.cleaning import clean_raw, clean_readings
from tidegrid.plans.dataset import prepare_dataset, transform_new
from tidegrid.plans.monitoring import monitoring_report, report_long
from tidegrid.session import settle, shared_folder
from tidegrid.sources import testdata as data
from tidegrid.sources.artifacts import load_published, publish
from tidegrid.sources.readings import scan_checked, scan_readings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HOURLY, DAILY = data.HOURLY, data.DAILY
DAILY_LIMIT = 3
# The day new data begins in `transform_new`.
NEW_SINCE = "2024-01-24 00:00:00"
HISTORY_SINCE = "2024-01-23 00:00:00"
# Weights of the linear model the recursive forecast is checked with.
LINEAR_WEIGHTS = {
    "lag_1h": 0.5,
    "lag_3h": 0.15,
    "lag_24h": 0.1,
    "rolling_mean_6h": 0.2,
    "sin_hour": 1.5,
}
LINEAR_INTERCEPT = 2.0


# The linear sequence model the recursion over windows is checked with: a feature's weight
# falls by a fifth with each row back.
WINDOW_SCALES = {"target": 0.1, "aux": 0.02, "sin_hour": 0.5, "lag_1h": 0.03, "rolling_mean_6h": 0.05}
WINDOW_LENGTH = 24
WINDOW_WEIGHTS = [[w * 0.8**age for w in WINDOW_SCALES.values()] for age in reversed(range(WINDOW_LENGTH))]
WINDOW_INTERCEPT = 3.0
# A model fed with its own forecasts nears the mean with each step: it is judged by the first.
JUDGED_STEPS = 6


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, so that results compare between engines.

    Means of decimals often end in exactly half a unit of the sixth digit, where the
    last bit decides the direction. The cut is therefore made a little below the half.
    """
    return df.select(
        *[
            F.expr(f"floor(`{f.name}` * 1e6D + 0.50005D) / 1e6D").alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


# --- sources and cleaning -------------------------------------------------------------


@query
def scan_readings_query(spark: SparkSession, sf: str) -> DataFrame:
    df = scan_readings(spark, f"{sf}/events.parquet", "parquet")
    return rounded(df.select("event_id", "ts", "event_type", "value"))


@query
def scan_unreadable(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as CSV, some with unreadable values, too few or too many fields."""
    path = data.events_csv(spark, sf)
    schema = "event_id bigint, ts timestamp_ntz, event_type string, value double"
    good, bad = scan_checked(spark, path, schema)
    none = F.lit(None)
    return rounded(
        good.select("*", none.cast("string").alias("reason")).unionByName(
            bad.select(
                F.element_at(F.split("record", ","), 1).cast("bigint").alias("event_id"),
                none.cast("timestamp_ntz").alias("ts"),
                none.cast("string").alias("event_type"),
                none.cast("double").alias("value"),
                "reason",
            )
        )
    )


@query
def normalize_columns_query(spark: SparkSession, sf: str) -> DataFrame:
    df = data.readings_hourly(spark, sf).select(
        "series_id",
        "ts",
        F.col("target").alias("pm2_5 (μg/m³)"),
        F.col("aux").alias("wind speed"),
        F.col("weather_code").alias("weather_code ()"),
    )
    return rounded(normalize_columns(df))


@query
def parse_time_query(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(parse_time(data.readings_raw(spark, sf), "time_text"))


@query
def drop_columns_query(spark: SparkSession, sf: str) -> DataFrame:
    df = data.readings_hourly(spark, sf).select(
        "series_id",
        "ts",
        "target",
        F.col("aux").alias("snowfall_(cm)"),
        F.col("aux").alias("carbon_dioxide_ppm"),
        F.col("aux").alias("methane_(μg/m³)"),
    )
    return rounded(drop_columns(df))


@query
def regrid_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(regrid(data.readings_offgrid(spark, sf), HOURLY))


@query
def duplicate_timestamps_query(spark: SparkSession, sf: str) -> DataFrame:
    events = data.table(spark, sf, "events").select(
        F.col("event_type").alias("series_id"), HOURLY.floor("ts").alias("ts")
    )
    return duplicate_timestamps(events, HOURLY)


@query
def encode_weather(spark: SparkSession, sf: str) -> DataFrame:
    df = regrid(data.readings_hourly(spark, sf).select("series_id", "ts", "weather_code"), HOURLY)
    return encode(df, "weather_code", fit_encoding(df, "weather_code"))


@query
def interpolate_linear(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(interpolate(data.readings_sparse(spark, sf), ["target"], HOURLY))


def _daily_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return interpolate(data.readings_daily(spark, sf), ["target"], DAILY, DAILY_LIMIT)


@query
def fill_seasonal_year(spark: SparkSession, sf: str) -> DataFrame:
    df = _daily_gaps(spark, sf)
    return rounded(fill_seasonal(df, ["target"], DAILY, same_month_hour=False))


@query
def fill_seasonal_month_hour(spark: SparkSession, sf: str) -> DataFrame:
    df = interpolate(data.readings_sparse(spark, sf), ["target"], HOURLY)
    return rounded(fill_seasonal(df, ["target"], HOURLY, same_day=False))


def _clean_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return clean_readings(data.readings_hourly(spark, sf), HOURLY)[0]


def _clean_sparse(spark: SparkSession, sf: str) -> DataFrame:
    return clean_readings(data.readings_sparse(spark, sf), HOURLY)[0]


@query
def clean_readings_query(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_clean_hourly(spark, sf))


@query
def clean_readings_sparse(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_clean_sparse(spark, sf))


@query
def clean_readings_daily(spark: SparkSession, sf: str) -> DataFrame:
    df = data.readings_daily(spark, sf)
    return rounded(clean_readings(df, DAILY, DAILY_LIMIT)[0])


@query
def clean_raw_query(spark: SparkSession, sf: str) -> DataFrame:
    """The whole chain from names with units and times as text."""
    raw = data.readings_delivered(spark, sf)
    return rounded(clean_raw(raw, HOURLY, series="station_name")[0])


# --- features ---------------------------------------------------------------------------


@query
def calendar_features(spark: SparkSession, sf: str) -> DataFrame:
    df = data.readings_hourly(spark, sf)
    return df.select("series_id", "ts", *calendar_columns(F.col("ts")))


@query
def cyclical_features(spark: SparkSession, sf: str) -> DataFrame:
    df = data.readings_hourly(spark, sf)
    return rounded(df.select("series_id", "ts", *cyclical_columns(F.col("ts"))))


def _gridded(spark: SparkSession, sf: str) -> DataFrame:
    return regrid(data.readings_hourly(spark, sf).select("series_id", "ts", "target"), HOURLY)


@query
def lag_features(spark: SparkSession, sf: str) -> DataFrame:
    df = history_features(_gridded(spark, sf), HOURLY, mean_windows=(), std_windows=())
    return rounded(df)


@query
def rolling_mean(spark: SparkSession, sf: str) -> DataFrame:
    df = history_features(_gridded(spark, sf), HOURLY, lags=(), std_windows=())
    return rounded(df)


@query
def rolling_std(spark: SparkSession, sf: str) -> DataFrame:
    df = history_features(_gridded(spark, sf), HOURLY, lags=(), mean_windows=())
    return rounded(df)


@query
def rolling_week(spark: SparkSession, sf: str) -> DataFrame:
    """Mean and standard deviation over windows of 168 cells."""
    table = _clean_hourly(spark, sf).select("series_id", "ts", "target")
    df = history_features(table, HOURLY, lags=(), mean_windows=(168,), std_windows=(168,))
    return rounded(df)


@query
def aqi_tier_query(spark: SparkSession, sf: str) -> DataFrame:
    events = data.table(spark, sf, "events")
    return events.select("event_id", aqi_tier(F.col("value")).alias("pm2_5_tier"))


def _features_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return feature_table(_clean_hourly(spark, sf), HOURLY)


@query
def feature_table_query(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_features_hourly(spark, sf))


@query
def feature_table_sparse(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(feature_table(_clean_sparse(spark, sf), HOURLY))


# --- split, scale, sequences --------------------------------------------------------------


def _split(spark: SparkSession, sf: str) -> DataFrame:
    return time_split(settle(_features_hourly(spark, sf)), HOURLY)


@query
def time_split_query(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf).select("series_id", "ts", "split", "split_row")


@query
def cv_folds_query(spark: SparkSession, sf: str) -> DataFrame:
    folds = cv_folds(settle(_features_hourly(spark, sf)), HOURLY)
    return folds.select("series_id", "ts", "fold", "role")


KEYS = ("series_id", "ts", "target", "split", "split_row")


@query
def select_features_query(spark: SparkSession, sf: str) -> DataFrame:
    """Booleans and short numeric texts become numbers, other texts are left out."""
    df = data.table(spark, sf, "lineitem").select(
        "l_quantity",
        F.col("l_linenumber").cast("string").alias("line_text"),
        (F.col("l_discount") > 0.05).alias("discounted"),
        "l_returnflag",
        F.col("l_partkey").cast("string").alias("part_text"),
    )
    typed, features = select_features(df)
    return rounded(typed.select(*features))


@query
def minmax_fit_query(spark: SparkSession, sf: str) -> DataFrame:
    split = _split(spark, sf)
    return rounded(minmax_fit(split, [c for c in split.columns if c not in KEYS]))


@query
def minmax_scale_query(spark: SparkSession, sf: str) -> DataFrame:
    split = settle(_split(spark, sf))
    bounds = read_bounds(minmax_fit(split, [c for c in split.columns if c not in KEYS]))
    return rounded(minmax_scale(split, bounds))


@query
def minmax_inverse_query(spark: SparkSession, sf: str) -> DataFrame:
    split = settle(_split(spark, sf).select(*KEYS))
    bounds = read_bounds(minmax_fit(split, ["target"]))
    scaled = minmax_scale(split, bounds, suffix="_scaled")
    return rounded(minmax_inverse(scaled, "target_scaled", bounds["target"], "target_again"))


@query
def transform_new_query(spark: SparkSession, sf: str) -> DataFrame:
    readings = data.readings_hourly(spark, sf)
    _, fitted = prepare_dataset(readings, HOURLY)
    recent = readings.filter(F.col("ts") >= F.lit(HISTORY_SINCE).cast("timestamp_ntz"))
    return rounded(transform_new(recent, fitted, HOURLY, since=NEW_SINCE))


@query
def saved_transform(spark: SparkSession, sf: str) -> DataFrame:
    """As `transform_new`, with state that was published and loaded again."""
    readings = data.readings_hourly(spark, sf)
    _, fitted = prepare_dataset(readings, HOURLY)
    base = shared_folder(spark, "published")
    publish(spark, base, fitted=fitted)
    recent = readings.filter(F.col("ts") >= F.lit(HISTORY_SINCE).cast("timestamp_ntz"))
    return rounded(transform_new(recent, load_published(spark, base).fitted, HOURLY, since=NEW_SINCE))


@query
def transform_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches in a row; the last one's rows are those of a run over all readings."""
    readings = data.readings_hourly(spark, sf)
    _, fitted = prepare_dataset(readings, HOURLY)
    cuts = ["2024-01-01 00:00:00", "2024-01-16 05:00:00", NEW_SINCE, "2024-12-31 00:00:00"]
    ts = F.col("ts")
    parts = [
        readings.filter((ts >= F.lit(a).cast("timestamp_ntz")) & (ts < F.lit(b).cast("timestamp_ntz")))
        for a, b in zip(cuts, cuts[1:])
    ]
    out = batches.transform_batches(parts, fitted, HOURLY)
    return rounded(out.filter(ts >= F.lit(NEW_SINCE).cast("timestamp_ntz")))


@query
def transform_new_text(spark: SparkSession, sf: str) -> DataFrame:
    """A text feature: numbers as text in training, new data with an unreadable one.

    Grid cells without a reading have no text, so their rows are incomplete.
    """
    readings = data.readings_hourly(spark, sf)
    mood = (F.hour("ts") % 3).cast("string")
    _, fitted = prepare_dataset(readings.withColumn("mood", mood), HOURLY)
    recent = readings.filter(F.col("ts") >= F.lit(HISTORY_SINCE).cast("timestamp_ntz"))
    recent = recent.withColumn("mood", F.when(F.hour("ts") == 5, "x").otherwise(mood))
    out = transform_new(recent, fitted, HOURLY, since=NEW_SINCE)
    return rounded(out.select("series_id", "ts", "mood"))


@query
def dotted_names(spark: SparkSession, sf: str) -> DataFrame:
    """The whole way to a dataset with a dot in a column's name."""
    readings = data.readings_hourly(spark, sf).withColumnRenamed("aux", "pm2.5")
    dataset = prepare_dataset(readings, HOURLY)[0]
    return rounded(dataset.withColumnRenamed("pm2.5", "aux"))


@query
def prepare_dataset_query(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(prepare_dataset(data.readings_hourly(spark, sf), HOURLY)[0])


@query
def sequence_windows_query(spark: SparkSession, sf: str) -> DataFrame:
    split = _split(spark, sf)
    columns = numeric_columns(split, exclude=("split_row",))
    windows = sequence_windows(split, columns, HOURLY)
    flat = F.flatten("window")
    return rounded(
        windows.select(
            "series_id",
            "ts",
            "split",
            "target",
            F.size("window").alias("length"),
            F.element_at(F.element_at("window", 1), columns.index("target") + 1).alias("first_target"),
            F.element_at(F.element_at("window", -1), columns.index("aux") + 1).alias("last_aux"),
            F.size(F.element_at("window", 1)).alias("width"),
            F.aggregate(flat, F.lit(0.0), lambda a, v: a + v).alias("total"),
        )
    )


# --- forecasts and their scores -------------------------------------------------------------


def _persistence(spark: SparkSession, sf: str) -> DataFrame:
    test = _split(spark, sf).filter(F.col("split") == "test")
    return forecasting.persistence(test).select(
        "series_id", "ts", "split_row", "actual", "predicted"
    )


@query
def forecast_first_horizon(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(forecasting.first_horizon(_persistence(spark, sf)))


@query
def forecast_recursive(spark: SparkSession, sf: str) -> DataFrame:
    starts = forecasting.origins(_clean_hourly(spark, sf), HOURLY)
    return rounded(
        forecasting.recursive_linear(starts, LINEAR_WEIGHTS, LINEAR_INTERCEPT, HOURLY)
    )


@query
def forecast_sequence_recursive(spark: SparkSession, sf: str) -> DataFrame:
    """24 steps from every window of 24 feature rows, with given weights."""
    table = settle(_features_hourly(spark, sf))
    features = list(WINDOW_SCALES)
    starts = forecasting.window_origins(table, features, HOURLY, WINDOW_LENGTH)
    return rounded(
        forecasting.recursive_window_linear(starts, features, WINDOW_WEIGHTS, WINDOW_INTERCEPT, grid=HOURLY)
    )


@query
def forecast_metrics(spark: SparkSession, sf: str) -> DataFrame:
    metrics = scoring.forecast_metrics(_persistence(spark, sf), by=["series_id"], digits=None)
    return rounded(metrics)


@query
def metrics_report(spark: SparkSession, sf: str) -> DataFrame:
    forecast = settle(_persistence(spark, sf))
    return scoring.metrics_report(
        forecast, forecasting.first_horizon(forecast), by=["series_id"]
    )


@query
def actual_vs_predicted(spark: SparkSession, sf: str) -> DataFrame:
    forecast = settle(_persistence(spark, sf))
    keys = ["series_id", "ts"]
    return rounded(
        scoring.actual_vs_predicted(
            forecast.select(*keys, "actual"), forecast.select(*keys, "predicted"), keys
        )
    )


@query
def error_histogram(spark: SparkSession, sf: str) -> DataFrame:
    forecast = settle(_persistence(spark, sf))
    errors = forecast.withColumn("error", F.col("actual") - F.col("predicted"))
    return rounded(scoring.histogram(errors, "error"))


# --- models -----------------------------------------------------------------------------------

LINEAR_FEATURES = ["lag_1h", "aux"]


def _dataset(spark: SparkSession, sf: str, source=data.readings_hourly):
    dataset, fitted = prepare_dataset(source(spark, sf), HOURLY)
    return settle(dataset), fitted


def _judged(forecast: DataFrame, train: DataFrame, target: str = "target") -> DataFrame:
    """Per series: rows, whether all have a forecast, and whether their squared errors are
    smaller than those of the mean of the train rows."""
    mean = train.filter(F.col("split") == "train").agg(F.avg("target").alias("_mean"))
    wrong, wrong_mean = F.col("predicted") - F.col(target), F.col("_mean") - F.col(target)
    return (
        forecast.join(F.broadcast(mean))
        .groupBy("series_id")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            (F.count("predicted") == F.count(F.lit(1))).alias("all_predicted"),
            (F.sum(wrong * wrong) < F.sum(wrong_mean * wrong_mean)).alias("beats_train_mean"),
        )
    )


@query
def train_linear(spark: SparkSession, sf: str) -> DataFrame:
    """Coefficients of a linear model on two features; the target has its usual name."""
    table = _split(spark, sf).withColumnRenamed("target", "pm2_5_(μg/m³)")
    target = resolve_target(table.columns, "pm2_5 (μg/m³)")
    model = models.train_model(settle(table), "Linear", LINEAR_FEATURES, label=target)
    fitted = model.stages[-1]
    terms = [("intercept", float(fitted.intercept))]
    terms += [(c, float(w)) for c, w in zip(LINEAR_FEATURES, fitted.coefficients)]
    rows = spark.createDataFrame(terms, "term string, weight double")
    return rows.select("term", F.round("weight", 4).alias("weight"))


@query
def train_random_forest(spark: SparkSession, sf: str) -> DataFrame:
    dataset, fitted = _dataset(spark, sf)
    model = models.train_model(dataset, "random_forest", fitted.features)
    return _judged(forecasting.forecast_single_step(model, dataset), dataset)


@query
def train_gbt(spark: SparkSession, sf: str) -> DataFrame:
    dataset, fitted = _dataset(spark, sf)
    model = models.train_model(dataset, "xgboost", fitted.features)
    return _judged(forecasting.forecast_single_step(model, dataset), dataset)


PRODUCTS_LENGTH = 6


@query
def window_products(spark: SparkSession, sf: str) -> DataFrame:
    """What a linear model on windows of six rows is fitted from, per window."""
    table = settle(_split(spark, sf))
    found = window_linear.window_products(table, ["target", "aux"], HOURLY, PRODUCTS_LENGTH)
    ones = found.filter("a = 0 AND b = 0 AND i = 2 AND j = 2").select(F.col("value").alias("_n"))
    # one number
    return found.join(F.broadcast(ones)).select("a", "b", "i", "j", F.round(F.col("value") / F.col("_n"), 4).alias("value"))


@query
def forecast_window_linear(spark: SparkSession, sf: str) -> DataFrame:
    """24 steps of a linear sequence model that was fitted from lagged products."""
    cleaned = clean_readings(data.readings_cyclic(spark, sf), HOURLY)[0]
    table = settle(time_split(settle(feature_table(cleaned, HOURLY)), HOURLY))
    features = ["target", "sin_hour", "cos_hour"]
    model = window_linear.train_window_linear(table, features, HOURLY)
    starts = forecasting.window_origins(table, features, HOURLY)
    forecast = forecasting.recursive_window_linear(starts, features, model.weights, model.intercept, grid=HOURLY)
    return _worth(forecast, table)


@query
def staged_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted trees by their number, and whether the cut model's error on the validation rows
    is the least that any number of trees has."""
    dataset, _ = _dataset(spark, sf, data.readings_cyclic)
    features = ["lag_1h", "lag_24h", "sin_hour", "cos_hour"]
    model, table = models.train_staged(dataset, features, trees=20, depth=4)
    val = dataset.filter(F.col("split") == "val")
    predicted = model.transform(val).select(F.avg((F.col("prediction") - F.col("target")) ** 2).alias("_error"))
    best = table.agg(F.min("val_error").alias("_best"), F.max(F.when(F.col("kept"), F.col("val_error"))).alias("_kept"))
    facts = predicted.crossJoin(best).select(
        ((F.col("_kept") == F.col("_best")) & (F.abs(F.col("_error") / F.col("_best") - 1) < 1e-9)).alias("cut_at_best")
    )
    falls = F.col("train_error") <= F.lag("train_error").over(Window.partitionBy(F.lit(0)).orderBy("trees"))
    # one row per tree
    return table.select("trees", F.coalesce(falls, F.lit(True)).alias("train_error_falls")).join(F.broadcast(facts))


@query
def train_sequence_model(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted trees on the windows of all features; the windows are not stored."""
    dataset, fitted = _dataset(spark, sf, data.readings_cyclic)
    samples = models.sequence_samples(dataset, ["target", *fitted.features], HOURLY)
    model = models.train_sequence_model(samples)
    return _judged(forecasting.forecast_single_step(model, samples), dataset)


@query
def forecast_single_step(spark: SparkSession, sf: str) -> DataFrame:
    """Forecasts of a forest in original units, with what they are worth per series."""
    dataset, fitted = _dataset(spark, sf)
    model = models.train_model(dataset, "random_forest", fitted.features)
    forecast = settle(forecasting.forecast_single_step(model, dataset))
    low, high = fitted.bounds[fitted.target]
    predicted = fitted.original_units(F.col("predicted"))
    worth = _judged(forecast, dataset).select("series_id", "beats_train_mean")
    return rounded(
        forecast.join(worth, "series_id").select(
            "series_id",
            "ts",
            fitted.original_units(F.col("target")).alias("actual"),
            predicted.isNotNull().alias("predicted_present"),
            predicted.between(low - 1e-9, high + 1e-9).alias("within_train_range"),
            "beats_train_mean",
        )
    )


def _worth(forecast: DataFrame, table: DataFrame) -> DataFrame:
    """Forecasts with the judgement of their series: the steps up to JUDGED_STEPS whose actual
    is known, against the mean of the train rows."""
    forecast = settle(forecast)
    actual = table.select("series_id", "ts", "target")
    judged = _judged(forecast.filter(F.col("step") <= JUDGED_STEPS).join(actual, ["series_id", "ts"]), table)
    return forecast.join(judged.select("series_id", "beats_train_mean"), "series_id").select(
        "series_id", "origin", "step", "ts", F.col("predicted").isNotNull().alias("predicted_present"), "beats_train_mean"
    )


@query
def forecast_recursive_model(spark: SparkSession, sf: str) -> DataFrame:
    """Forecasts of a boosted model that reads only values before each step."""
    cleaned = settle(clean_readings(data.readings_cyclic(spark, sf), HOURLY)[0])
    table = settle(time_split(settle(feature_table(cleaned, HOURLY, shift=1)), HOURLY))
    # what the steps can be given: every feature but the tier and other measurements
    model = models.train_model(table, "gbt", forecasting.step_feature_names())
    forecast = forecasting.recursive_model(forecasting.origins(cleaned, HOURLY), model, HOURLY)
    return _worth(forecast, table)


@query
def forecast_sequence_model(spark: SparkSession, sf: str) -> DataFrame:
    """24 steps of a trained sequence model from every window of the feature table."""
    dataset, fitted = _dataset(spark, sf, data.readings_cyclic)
    features = ["target", *fitted.features]
    model = models.train_sequence_model(models.sequence_samples(dataset, features, HOURLY))
    kept = [named(c) for c in dataset.columns if c not in ("target", "target_raw")]
    # windows are in original units
    scales = {c: b for c, b in fitted.bounds.items() if c in fitted.features}
    table = minmax_unscale(dataset.select(*kept, F.col("target_raw").alias("target")), scales)
    starts = forecasting.window_origins(settle(table), features, HOURLY)
    forecast = forecasting.recursive_window_model(starts, model, features, grid=HOURLY, bounds=fitted.bounds)
    return _worth(forecast, table)


COURSE = ["sin_hour", "cos_hour", "weather_code"]


@query
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    """All features, whether their shares of a full forest's gain are shares, and a rank.

    Lags and the tier tell the target's course as well as the hour does, so a rank is known
    only between features that have a forest of their own: the course has more of the sine
    than of the cosine, and nothing of the weather code. The others' rank is NULL.
    """
    dataset, fitted = _dataset(spark, sf, data.readings_cyclic)

    def shares(features: list[str]) -> DataFrame:
        model = models.train_model(dataset, "random_forest", features)
        return models.feature_importance(model, dataset, features)

    whole, course = shares(fitted.features), shares(COURSE)
    # one row per forest
    sums = whole.agg(F.sum("importance").alias("_sum")).union(course.agg(F.sum("importance")))
    total = sums.agg(F.bool_and(F.abs(F.col("_sum") - 1) < 1e-9).alias("shares_sum_to_one"))
    # one row per feature
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("importance"), "feature"))
    ranks = course.select("feature", rank.alias("rank"))
    signs = whole.select("feature", (F.col("importance") >= 0).alias("not_negative"))
    return signs.join(F.broadcast(total)).join(ranks, "feature", "left")


# --- monitoring -------------------------------------------------------------------------------


def _monitored(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """The split table and all its numeric columns."""
    df = settle(_split(spark, sf))
    return df, numeric_columns(df, exclude=("split_row",))


@query
def drift_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(drift.drift_report(*_monitored(spark, sf)))


@query
def drift_summary(spark: SparkSession, sf: str) -> DataFrame:
    return drift.drift_summary(drift.drift_report(*_monitored(spark, sf)))


@query
def target_stats(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(drift.target_stats(_split(spark, sf), "target"))


@query
def target_shift(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(drift.target_shift(_split(spark, sf), "target"))


@query
def target_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(drift.target_histogram(_monitored(spark, sf)[0], "target"))


@query
def target_boxplot(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(drift.target_boxplot(_monitored(spark, sf)[0], "target"))


@query
def quality_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_summary(_split(spark, sf), "split")


@query
def missing_values(spark: SparkSession, sf: str) -> DataFrame:
    df = parse_time(data.readings_raw(spark, sf), "time_text")
    return quality.missing_values(df, ["ts", "target"], by="series_id")


@query
def duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = parse_time(data.readings_raw(spark, sf), "time_text")
    return quality.duplicate_rows(df, ["target"], by="series_id")


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query
def iqr_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.iqr_outliers(data.table(spark, sf, "lineitem"), LINE_NUMBERS))


@query
def iqr_outliers_events(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(quality.iqr_outliers(data.table(spark, sf, "events"), ["value"]))


@query
def clip_outliers(spark: SparkSession, sf: str) -> DataFrame:
    events = data.table(spark, sf, "events").select("event_id", "event_type", "value")
    return rounded(quality.clip_outliers(events, ["value"]))


@query
def correlation_matrix(spark: SparkSession, sf: str) -> DataFrame:
    lines = data.table(spark, sf, "lineitem").withColumn("constant", F.lit(1.0))
    return rounded(quality.correlation_matrix(lines, [*LINE_NUMBERS, "l_linenumber", "constant"]))


@query
def monitoring_report_query(spark: SparkSession, sf: str) -> DataFrame:
    df, columns = _monitored(spark, sf)
    features = [c for c in columns if c != "target"]
    return rounded(report_long(monitoring_report(df, features, "target")))


# --- runs and registry ----------------------------------------------------------------------------


@query
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    df = experiments.run_metrics(data.runs(spark, sf))
    return rounded(df.drop("tags"))


@query
def filter_runs(spark: SparkSession, sf: str) -> DataFrame:
    df = experiments.filter_runs(data.runs(spark, sf), "finished", ["1-URGENT", "2-HIGH"])
    return df.select("run_id", "name", "state", F.element_at("tags", 1).alias("tag"))


def _counted(spark: SparkSession, sf: str) -> DataFrame:
    metrics = experiments.run_metrics(data.runs(spark, sf))
    return experiments.run_artifacts(metrics, data.artifacts(spark, sf))


@query
def run_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    return _counted(spark, sf).select(
        "run_id", "artifacts_count", "model_artifacts", "first_model", "first_version",
        "registration",
    )


@query
def run_model_details(spark: SparkSession, sf: str) -> DataFrame:
    metrics = experiments.run_metrics(data.runs(spark, sf))
    return experiments.run_model_details(metrics, data.artifacts(spark, sf))


@query
def runs_summary(spark: SparkSession, sf: str) -> DataFrame:
    return experiments.runs_summary(_counted(spark, sf))


@query
def runs_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    metrics = experiments.run_metrics(data.runs(spark, sf))
    return rounded(experiments.runs_leaderboard(metrics, data.artifacts(spark, sf)))


@query
def problem_runs(spark: SparkSession, sf: str) -> DataFrame:
    return experiments.problem_runs(experiments.run_metrics(data.runs(spark, sf)))


@query
def unregistered_top_runs(spark: SparkSession, sf: str) -> DataFrame:
    metrics = experiments.run_metrics(data.runs(spark, sf))
    return rounded(experiments.unregistered_top_runs(metrics, data.artifacts(spark, sf)))


@query
def run_labels(spark: SparkSession, sf: str) -> DataFrame:
    return experiments.run_labels(_counted(spark, sf))


@query
def run_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Every third id is a full path already."""
    key = F.col("run_id")
    mixed = data.runs(spark, sf).select(
        F.when(key % 3 == 0, F.concat(F.lit("team/other/"), key.cast("string")))
        .otherwise(key.cast("string"))
        .alias("run_id")
    )
    return experiments.run_paths(mixed, "team", "air")


@query
def registrable_models(spark: SparkSession, sf: str) -> DataFrame:
    return experiments.registrable_models(data.runs(spark, sf), data.artifacts(spark, sf))


@query
def registry_models(spark: SparkSession, sf: str) -> DataFrame:
    df = registry.registry_models(data.registry(spark, sf), data.runs(spark, sf))
    return rounded(df.drop("aliases"))


@query
def alias_status_query(spark: SparkSession, sf: str) -> DataFrame:
    df = data.registry(spark, sf)
    return df.select("version_id", alias_status(F.col("aliases"), F.col("version")).alias("status"))


@query
def registry_summary(spark: SparkSession, sf: str) -> DataFrame:
    return registry.registry_summary(data.registry(spark, sf))


@query
def registry_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    df = registry.registry_models(data.registry(spark, sf), data.runs(spark, sf))
    return rounded(registry.registry_leaderboard(df))


@query
def registry_by_stage(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(registry.registry_by_stage(data.registry(spark, sf), data.runs(spark, sf)))


@query
def apply_promotions(spark: SparkSession, sf: str) -> DataFrame:
    df = registry.apply_promotions(data.registry(spark, sf), data.promotions(spark, sf))
    return df.select(
        "version_id", "version", F.array_join("aliases", ",").alias("aliases_csv"), "promoted"
    )


@query
def rejected_promotions(spark: SparkSession, sf: str) -> DataFrame:
    return registry.rejected_promotions(data.registry(spark, sf), data.promotions(spark, sf))


def all_queries() -> dict[str, Query]:
    """Queries by name; functions that would hide an operator carry ``_query`` at the end."""
    return {name.removesuffix("_query"): fn for name, fn in QUERIES.items()}
