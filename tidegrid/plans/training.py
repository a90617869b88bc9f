"""A whole training run: prepare, train, score, monitor, save."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.grid import Grid
from tidegrid.operators.forecasting import (
    DEFAULT_HORIZON,
    first_horizon,
    forecast_single_step,
)
from tidegrid.operators.models import (
    SEQUENCE,
    sequence_samples,
    train_model,
    train_sequence_model,
)
from tidegrid.operators.scoring import metrics_report
from tidegrid.operators.sequences import DEFAULT_LENGTH
from tidegrid.plans.dataset import Fitted, prepare_dataset
from tidegrid.plans.monitoring import monitoring_report
from tidegrid.session import settle
from tidegrid.sources.artifacts import save_artifacts


@dataclass
class TrainingRun:
    model: PipelineModel
    fitted: Fitted
    forecast: DataFrame
    metrics: DataFrame
    report: dict[str, DataFrame]


def score(
    forecast: DataFrame, fitted: Fitted, horizon: int = DEFAULT_HORIZON
) -> DataFrame:
    """Metrics in scaled units under their plain names, and in original units as ``_raw``."""
    scaled = metrics_report(forecast, first_horizon(forecast, horizon))
    back = forecast.select(
        "split_row",
        fitted.original_units(F.col("actual")).alias("actual"),
        fitted.original_units(F.col("predicted")).alias("predicted"),
    )
    raw = metrics_report(back, first_horizon(back, horizon))
    return scaled.unionByName(raw.withColumn("metric", F.concat(F.col("metric"), F.lit("_raw"))))


def run_training(
    raw: DataFrame,
    model_name: str = "random_forest",
    grid: Grid = Grid(),
    target: str = "target",
    horizon: int = DEFAULT_HORIZON,
    length: int = DEFAULT_LENGTH,
    save_to: str | None = None,
    **params,
) -> TrainingRun:
    """Train one model and report on it; the test rows are predicted once."""
    dataset, fitted = prepare_dataset(raw, grid, target)
    if model_name.lower() in SEQUENCE:
        # a window per row is made anew in each pass, not stored
        rows = sequence_samples(settle(dataset), fitted.features, grid, length)
        model = train_sequence_model(rows, fitted.target, **params)
    else:
        rows = dataset
        model = train_model(rows, model_name, fitted.features, fitted.target, **params)
    predicted = forecast_single_step(model, rows)
    forecast = settle(
        predicted.select(
            grid.series, grid.ts, "split_row", F.col(fitted.target).alias("actual"), "predicted"
        )
    )
    if model_name.lower() in SEQUENCE:
        # the first forecast belongs to the row after the first window
        forecast = forecast.withColumn("split_row", F.col("split_row") - length)
    metrics = score(forecast, fitted, horizon)
    report = monitoring_report(dataset, fitted.features, fitted.target)
    if save_to:
        save_artifacts(raw.sparkSession, save_to, model, fitted, metrics, report)
    return TrainingRun(model, fitted, forecast, metrics, report)
