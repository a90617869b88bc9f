"""Forecast metrics, aligned series of actual and predicted values, error histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.grid import named

# Smallest MAPE denominator (machine epsilon), number of bins, digits.
EPSILON = 2.220446049250313e-16
ERROR_BINS = 30
METRIC_DIGITS = 6
METRIC_NAMES = ("mae", "mape", "mse", "rmse", "r2", "accuracy")


def forecast_metrics(
    df: DataFrame,
    actual: str = "actual",
    predicted: str = "predicted",
    by: Sequence[str] = (),
    digits: int | None = METRIC_DIGITS,
) -> DataFrame:
    """MAE, MAPE, MSE, RMSE, R2 and 1 - MAPE over the rows that have both values.

    R2 of a constant actual is 1 without any error and 0 otherwise.
    """
    y, yhat = F.col(actual), F.col(predicted)
    error = y - yhat
    mae = F.avg(F.abs(error))
    mape = F.avg(F.abs(error) / F.greatest(F.abs(y), F.lit(EPSILON)))
    mse = F.avg(error * error)
    spread = F.var_pop(y)
    r2 = F.when(spread == 0, F.when(mse == 0, 1.0).otherwise(0.0)).otherwise(
        1 - F.try_divide(mse, spread)
    )
    metrics = dict(zip(METRIC_NAMES, (mae, mape, mse, F.sqrt(mse), r2, 1 - mape)))
    columns = [
        (F.round(m, digits) if digits is not None else m).alias(name)
        for name, m in metrics.items()
    ]
    scored = df.filter(y.isNotNull() & yhat.isNotNull())
    return (scored.groupBy(*by) if by else scored).agg(*columns)


def metrics_long(metrics: DataFrame, stage: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per metric: ``(by..., stage, metric, value)``."""
    entries = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRIC_NAMES]
    )
    return metrics.select(*by, F.lit(stage).alias("stage"), F.explode(entries).alias("e")).select(
        *by, "stage", "e.metric", "e.value"
    )


def metrics_report(
    single: DataFrame,
    horizon: DataFrame,
    actual: str = "actual",
    predicted: str = "predicted",
    by: Sequence[str] = (),
) -> DataFrame:
    """Train-time, single-step and multi-step metrics in one long table.

    The train-time metrics are by definition those of the single-step forecast.
    """
    one = forecast_metrics(single, actual, predicted, by)
    many = forecast_metrics(horizon, actual, predicted, by)
    return (
        metrics_long(one, "train_metrics", by)
        .unionByName(metrics_long(one, "single_step_metrics", by))
        .unionByName(metrics_long(many, "multi_step_metrics", by))
    )


def actual_vs_predicted(
    actuals: DataFrame, predictions: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Actual and predicted values side by side, with their error."""
    joined = actuals.join(predictions, list(keys))
    return joined.withColumn("error", F.col("actual") - F.col("predicted"))


def bin_number(value: Column, lo: float, hi: float, bins: int) -> Column:
    """Bin 0..bins-1 of equal width; the last is closed on the right."""
    if hi == lo:
        # a constant column is binned over [x - 0.5, x + 0.5]
        lo, hi = lo - 0.5, hi + 0.5
    place = F.floor((value - F.lit(lo)) / F.lit((hi - lo) / bins)).cast("int")
    return F.least(place, F.lit(bins - 1))


def histogram(
    df: DataFrame,
    value: str,
    bins: int = ERROR_BINS,
    by: str | None = None,
    groups: Sequence[str] = (),
) -> DataFrame:
    """Equal-width histogram with counts and densities, per group over its own range.

    Ranges are read first (one row per group); every bin is listed, also empty ones.
    """
    column = named(value).cast("double")
    names = [None] if by is None else list(groups)
    inside = [F.lit(True) if g is None else F.col(by) == g for g in names]
    ends = df.agg(
        *[F.min(F.when(c, column)).alias(f"lo{i}") for i, c in enumerate(inside)],
        *[F.max(F.when(c, column)).alias(f"hi{i}") for i, c in enumerate(inside)],
        *[F.count(F.when(c, column)).alias(f"n{i}") for i, c in enumerate(inside)],
    ).first()
    ranges = {g: (ends[f"lo{i}"], ends[f"hi{i}"], ends[f"n{i}"]) for i, g in enumerate(names)}
    part, place = histogram_place(column, bins, by, ranges)
    counted = df.filter(column.isNotNull()).groupBy(part.alias("_part"), place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return histogram_of(counted, bins, by, ranges)


# Per group: least and greatest value and their number.
Ranges = Mapping[str | None, tuple[float | None, float | None, int]]


def histogram_place(value: Column, bins: int, by: str | None, ranges: Ranges) -> tuple[Column, Column]:
    """The number of a row's group and the bin its value falls into."""
    part, place = F.lit(None).cast("int"), F.lit(None).cast("int")
    for i, (g, (lo, hi, n)) in enumerate(ranges.items()):
        if n:
            inside = F.lit(True) if by is None else F.col(by) == g
            part = F.when(inside, F.lit(i)).otherwise(part)
            place = F.when(inside, bin_number(value, lo, hi, bins)).otherwise(place)
    return part, place


def histogram_of(counted: DataFrame, bins: int, by: str | None, ranges: Ranges) -> DataFrame:
    """The histogram from its counts ``(_part, bin, n)``; every bin is listed."""
    edges = []
    for i, (g, (lo, hi, n)) in enumerate(ranges.items()):
        if n:
            low, high = (lo, hi) if hi > lo else (lo - 0.5, hi + 0.5)
            width = (high - low) / bins
            edges += [(i, g, b, low + b * width, low + (b + 1) * width, width, n) for b in range(bins)]
    frame = counted.sparkSession.createDataFrame(
        edges,
        "_part int, _group string, bin int, bin_start double, bin_end double, "
        "_width double, _total bigint",
    )
    # both sides hold at most one row per group and bin
    table = frame.join(F.broadcast(counted), ["_part", "bin"], "left").select(
        *([F.col("_group").alias(by)] if by else []),
        "bin",
        "bin_start",
        "bin_end",
        F.coalesce("n", F.lit(0)).alias("n"),
        (F.coalesce("n", F.lit(0)) / (F.col("_total") * F.col("_width"))).alias("density"),
    )
    return table
