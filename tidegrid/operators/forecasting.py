"""Single-step, first-horizon and recursive multi-step forecasts."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.grid import Grid, named, own_rows, with_halo
from tidegrid.operators.features import (
    LAGS,
    MEAN_WINDOWS,
    STD_WINDOWS,
    aqi_tier,
    calendar_columns,
    cyclical_columns,
)
from tidegrid.operators.scaling import Bounds, scaled, unscaled
from tidegrid.operators.sequences import DEFAULT_LENGTH
from tidegrid.session import settle

DEFAULT_HORIZON = 24


def forecast_single_step(model: Model, df: DataFrame, split: str = "split") -> DataFrame:
    """Predict every test row."""
    test = df.filter(F.col(split) == "test")
    return model.transform(test).withColumnRenamed("prediction", "predicted")


def first_horizon(
    forecast: DataFrame, horizon: int = DEFAULT_HORIZON, position: str = "split_row"
) -> DataFrame:
    """The first ``horizon`` test rows of each series: rows are already numbered."""
    return forecast.filter(F.col(position) <= horizon)


def origins(
    df: DataFrame, grid: Grid = Grid(), target: str = "target", length: int = max(LAGS)
) -> DataFrame:
    """``(series, origin, history)`` for each row with a full history.

    The history holds the last ``length`` values, the latest first, including that
    of the origin itself. Rows with a missing value in it are left out.
    """
    slim = df.select(grid.series, F.col(grid.ts).alias("origin"), F.col(target).alias("_v"))
    at = Grid(grid.series, "origin", grid.freq_seconds, grid.chunk_cells)
    haloed = with_halo(slim, at.cell(), max(grid.chunk_cells, length), length - 1)
    ordered = (
        Window.partitionBy(grid.series, "_chunk").orderBy("origin").rowsBetween(-(length - 1), 0)
    )
    collected = own_rows(
        haloed.withColumn("history", F.reverse(F.collect_list(F.col("_v").cast("double")).over(ordered)))
    )
    return collected.filter(F.size("history") == length).select(grid.series, "origin", "history")


def step_features(history: Column, at: Column) -> dict[str, Column]:
    """Features of a step from the values before it; nothing of the step itself is used."""

    def mean(values: Column, w: int) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v) / w

    features = {f"lag_{k}h": F.get(history, F.lit(k - 1)) for k in LAGS}
    for w in MEAN_WINDOWS:
        recent = F.slice(history, 1, w)
        features[f"rolling_mean_{w}h"] = mean(recent, w)
        if w in STD_WINDOWS:
            average = mean(recent, w)
            squares = F.aggregate(
                F.transform(recent, lambda v, m=average: (v - m) * (v - m)),
                F.lit(0.0),
                lambda acc, v: acc + v,
            )
            features[f"rolling_std_{w}h"] = F.sqrt(squares / (w - 1))
    names = ("hour", "day", "month", "day_of_week", "is_weekend", "is_night")
    features.update(zip(names, calendar_columns(at)))
    features.update(zip(("sin_hour", "cos_hour"), cyclical_columns(at)))
    return features


def step_feature_names() -> list[str]:
    return list(step_features(F.col("history"), F.col("origin")))


def _later(origin: Column, step: Column, grid: Grid) -> Column:
    zero = F.lit(0)
    seconds = (step * grid.freq_seconds).cast("decimal(18,6)")
    return origin + F.make_dt_interval(zero, zero, zero, seconds)


def recursive_linear(
    starts: DataFrame,
    weights: Mapping[str, float],
    intercept: float = 0.0,
    grid: Grid = Grid(),
    horizon: int = DEFAULT_HORIZON,
) -> DataFrame:
    """Forecast ``horizon`` steps from each origin with a linear model.

    Each prediction becomes lag 1 of the next step. The whole recursion is one
    fold over the steps inside a single projection: no shuffle, no Python, and the
    plan does not grow with the horizon.
    """
    unknown = set(weights) - set(step_features(F.col("history"), F.col("origin")))
    if unknown:
        raise ValueError(f"no step features {sorted(unknown)}")

    def step(state: Column, k: Column) -> Column:
        history = state["history"]
        features = step_features(history, _later(F.col("origin"), k, grid))
        prediction = F.lit(float(intercept))
        for name, weight in weights.items():
            prediction = prediction + F.lit(float(weight)) * features[name]
        shifted = F.slice(F.concat(F.array(prediction), history), 1, F.size(history))
        return F.struct(
            shifted.alias("history"),
            F.concat(state["predictions"], F.array(prediction)).alias("predictions"),
        )

    begin = F.struct(
        F.col("history").alias("history"),
        F.array().cast("array<double>").alias("predictions"),
    )
    steps = F.sequence(F.lit(1), F.lit(horizon))
    folded = F.aggregate(steps, begin, step, lambda state: state["predictions"])
    return _long(starts.select(grid.series, "origin", folded.alias("_predictions")), grid)


def recursive_model(
    starts: DataFrame,
    model: Model,
    grid: Grid = Grid(),
    horizon: int = DEFAULT_HORIZON,
    settle_every: int = 6,
) -> DataFrame:
    """Forecast ``horizon`` steps from each origin with any fitted model.

    The model has to read features named as in :func:`step_features`. Each step is
    one distributed transform over all origins; the plan is cut every few steps.
    """
    state = starts.select(
        grid.series, "origin", "history", F.array().cast("array<double>").alias("_predictions")
    )
    keep = state.columns
    for k in range(1, horizon + 1):
        at = _later(F.col("origin"), F.lit(k), grid)
        features = step_features(F.col("history"), at)
        predicted = model.transform(
            state.select("*", *[c.alias(name) for name, c in features.items()])
        )
        latest = F.array(F.col("prediction"))
        state = predicted.select(
            grid.series,
            "origin",
            F.slice(F.concat(latest, F.col("history")), 1, F.size("history")).alias("history"),
            F.concat(F.col("_predictions"), latest).alias("_predictions"),
        ).select(*keep)
        if settle_every and k % settle_every == 0 and k < horizon:
            state = settle(state)
    return _long(state.drop("history"), grid)


def _long(df: DataFrame, grid: Grid) -> DataFrame:
    rows = df.select(grid.series, "origin", F.posexplode("_predictions").alias("_at", "predicted"))
    step = F.col("_at") + 1
    return rows.select(
        grid.series,
        "origin",
        step.alias("step"),
        _later(F.col("origin"), step, grid).alias(grid.ts),
        "predicted",
    )


# --- sequence models: the state of an origin is its last feature rows ----------------------


def window_origins(
    df: DataFrame, features: Sequence[str], grid: Grid = Grid(), length: int = DEFAULT_LENGTH
) -> DataFrame:
    """``(series, origin, window)`` for each row that ends ``length`` complete rows in a row.

    The window holds the features of these rows, oldest first, that of the origin last.
    Rows must follow each other on the grid; one missing or incomplete row in between
    makes no window.
    """
    if length < 1:
        raise ValueError("length must be positive")
    values = F.array(*[named(c).cast("double") for c in features])
    complete = reduce(and_, [named(c).isNotNull() for c in features])
    slim = df.select(grid.series, F.col(grid.ts).alias("origin"), F.when(complete, values).alias("_row"))
    at = Grid(grid.series, "origin", grid.freq_seconds, grid.chunk_cells)
    haloed = with_halo(slim.withColumn("_cell", at.cell()), F.col("_cell"), max(grid.chunk_cells, length), length - 1)
    recent = Window.partitionBy(grid.series, "_chunk").orderBy("_cell").rangeBetween(-(length - 1), 0)
    windows = own_rows(haloed.withColumn("window", F.collect_list("_row").over(recent)))
    return windows.filter(F.size("window") == length).select(grid.series, "origin", "window")


# What a feature of the next row is made of, by its name.
_HISTORIES = ((re.compile(r"lag_(\d+)h"), "lag"), (re.compile(r"rolling_mean_(\d+)h"), "mean"), (re.compile(r"rolling_std_(\d+)h"), "std"))


def _kind(name: str) -> tuple[str, int] | None:
    for pattern, kind in _HISTORIES:
        match = pattern.fullmatch(name)
        if match:
            return kind, int(match[1])
    return None


def next_row(
    window: Column, predicted: Column, at: Column, features: Sequence[str], target: str = "target"
) -> Column:
    """The features of the row at time ``at``, once its target is predicted.

    The target is the prediction; lags, rolling values (of windows that end at the row
    itself) and the tier follow from it and the window; the calendar follows from the
    time. Whatever else was measured is taken to stay as it was in the last row.
    """
    position = list(features).index(target)
    last = F.element_at(window, -1)
    # the latest first, the prediction at the front
    targets = F.concat(F.array(predicted), F.reverse(F.transform(window, lambda row: F.get(row, F.lit(position)))))
    calendar = dict(zip(("hour", "day", "month", "day_of_week", "is_weekend", "is_night"), calendar_columns(at)))
    calendar |= dict(zip(("sin_hour", "cos_hour"), cyclical_columns(at)))

    def build(history: Column, i: int, name: str) -> Column:
        def total(values: Column) -> Column:
            return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)

        if name == target:
            return F.get(history, F.lit(0))
        if name in calendar:
            return calendar[name].cast("double")
        if name == "pm2_5_tier":
            return aqi_tier(F.get(history, F.lit(0))).cast("double")
        kind, w = _kind(name) or ("", 0)
        recent = F.slice(history, 1, max(w, 1))
        if kind == "lag":
            return F.get(history, F.lit(w))
        if kind == "mean":
            return total(recent) / w
        if kind == "std":
            return F.get(
                F.transform(
                    F.array(total(recent) / w),
                    lambda mean: F.sqrt(total(F.transform(recent, lambda v: (v - mean) * (v - mean))) / (w - 1)),
                ),
                F.lit(0),
            )
        return F.get(last, F.lit(i))

    # the one-element array binds the history, which many features read, to a name
    rows = F.transform(F.array(targets), lambda history: F.array(*[build(history, i, c) for i, c in enumerate(features)]))
    return F.get(rows, F.lit(0))


def _check_window(features: Sequence[str], target: str, length: int) -> None:
    if target not in features:
        raise ValueError(f"the window has to hold the target {target}")
    for name in features:
        kind, w = _kind(name) or ("", 0)
        if w > length + (kind != "lag"):
            raise ValueError(f"{name} looks back further than {length} rows")


def recursive_window_linear(
    starts: DataFrame,
    features: Sequence[str],
    weights: Sequence[Sequence[float]],
    intercept: float = 0.0,
    target: str = "target",
    grid: Grid = Grid(),
    horizon: int = DEFAULT_HORIZON,
) -> DataFrame:
    """Forecast ``horizon`` steps from each window with a linear sequence model.

    ``weights`` has a row of weights for each row of the window, the oldest first. A
    prediction is pushed into the window as the target of the next row (see
    :func:`next_row`). The recursion is one fold inside a single projection.
    """
    _check_window(features, target, len(weights))
    flat = F.array(*[F.lit(float(w)) for row in weights for w in row])

    def step(state: Column, k: Column) -> Column:
        products = F.zip_with(F.flatten(state["window"]), flat, lambda x, w: x * w)
        prediction = F.aggregate(products, F.lit(float(intercept)), lambda acc, v: acc + v)
        at = _later(F.col("origin"), k, grid)

        def pushed(p: Column) -> Column:
            row = next_row(state["window"], p, at, features, target)
            return F.struct(
                F.concat(F.slice(state["window"], 2, len(weights) - 1), F.array(row)).alias("window"),
                F.concat(state["predictions"], F.array(p)).alias("predictions"),
            )

        return F.get(F.transform(F.array(prediction), pushed), F.lit(0))

    begin = F.struct(F.col("window").alias("window"), F.array().cast("array<double>").alias("predictions"))
    steps = F.sequence(F.lit(1), F.lit(horizon))
    folded = F.aggregate(steps, begin, step, lambda state: state["predictions"])
    return _long(starts.select(grid.series, "origin", folded.alias("_predictions")), grid)


def recursive_window_model(
    starts: DataFrame,
    model: Model,
    features: Sequence[str],
    target: str = "target",
    grid: Grid = Grid(),
    horizon: int = DEFAULT_HORIZON,
    length: int = DEFAULT_LENGTH,
    bounds: Bounds | None = None,
    settle_every: int = 6,
) -> DataFrame:
    """Forecast ``horizon`` steps from each window with any fitted sequence model.

    The model reads the flattened window from ``features``, as
    :func:`tidegrid.operators.models.sequence_samples` gives it. Windows are in original
    units; with ``bounds`` the model sees them scaled, and its predictions are scaled back.
    Each step is one distributed transform over all origins.
    """
    _check_window(features, target, length)
    bounds = dict(bounds or {})

    def seen(row: Column) -> Column:
        cells = [(F.get(row, F.lit(i)), c) for i, c in enumerate(features)]
        return F.array(*[scaled(v, *bounds[c]) if c in bounds else v for v, c in cells])

    state = starts.select(grid.series, "origin", "window", F.array().cast("array<double>").alias("_predictions"))
    keep = state.columns
    for k in range(1, horizon + 1):
        vector = array_to_vector(F.flatten(F.transform("window", seen)))
        predicted = model.transform(state.withColumn("features", vector))
        value = F.col("prediction")
        value = unscaled(value, *bounds[target]) if target in bounds else value
        stepped = predicted.select(*keep, value.alias("_p"))
        row = next_row(F.col("window"), F.col("_p"), _later(F.col("origin"), F.lit(k), grid), features, target)
        pushed = F.struct(
            F.concat(F.slice("window", 2, length - 1), F.array(row)).alias("window"),
            F.concat("_predictions", F.array("_p")).alias("_predictions"),
        )
        # exploded, a step's state is computed once; a projection would be folded into the
        # next ones, which read it many times
        state = stepped.select(grid.series, "origin", F.explode(F.array(pushed)).alias("s")).select(grid.series, "origin", "s.*")
        if settle_every and k % settle_every == 0 and k < horizon:
            state = settle(state)
    return _long(state.drop("window"), grid)


def persistence(df: DataFrame, lag: str = "lag_1h", target: str = "target") -> DataFrame:
    """The value one step before as forecast: the yardstick of every model."""
    return df.select("*", F.col(target).alias("actual"), F.col(lag).alias("predicted"))

