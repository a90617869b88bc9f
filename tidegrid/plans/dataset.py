"""From raw readings to a scaled, split training table, and the same for new data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidegrid.grid import Grid, named
from tidegrid.operators.features import feature_table
from tidegrid.operators.gaps import DEFAULT_LIMIT
from tidegrid.operators.naming import resolve_target
from tidegrid.operators.scaling import (
    minmax_fit,
    minmax_scale,
    read_bounds,
    select_features,
    unscaled,
)
from tidegrid.operators.splitting import DEFAULT_RATIOS, check_ratios, time_split
from tidegrid.plans.cleaning import clean_readings
from tidegrid.session import settle


@dataclass
class Fitted:
    """What is learnt from training data: small tables only."""

    target: str
    features: list[str]
    bounds: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    encoding: DataFrame | None = None
    # features that were text in training
    texts: list[str] = field(default_factory=list)

    def original_units(self, value: Column) -> Column:
        return unscaled(value, *self.bounds[self.target])


def prepare_dataset(
    raw: DataFrame,
    grid: Grid = Grid(),
    target: str = "target",
    ratios: tuple[float, float, float] = DEFAULT_RATIOS,
    limit: int = DEFAULT_LIMIT,
    shift: int = 0,
) -> tuple[DataFrame, Fitted]:
    """Clean, engineer, split and scale; the target in original units stays as ``<target>_raw``.

    The features are settled before the split, which reads them twice, and the split
    table after it, since fitting and everything later read it again.
    """
    check_ratios(*ratios)
    target = resolve_target(raw.columns, target)
    cleaned, encoding = clean_readings(raw, grid, limit)
    table = settle(feature_table(cleaned, grid, target, shift=shift))
    split = settle(time_split(table, grid, ratios))
    keys = (grid.series, grid.ts, target, "split", "split_row")
    typed, features = select_features(split, exclude=keys)
    bounds = read_bounds(minmax_fit(typed, [*features, target]))
    texts = [f.name for f in split.schema.fields if isinstance(f.dataType, StringType) and f.name in features]
    kept = typed.withColumn(f"{target}_raw", named(target))
    return minmax_scale(kept, bounds), Fitted(target, features, bounds, encoding, texts)


def transform_new(
    readings: DataFrame,
    fitted: Fitted,
    grid: Grid = Grid(),
    since: str | None = None,
    limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """Process new readings with stored encoding and scaling.

    Readings before ``since`` are history: they give the first new rows their lags
    and are dropped afterwards. Weather labels unseen in training become -1. Text that
    was a feature in training is read as numbers again; what is no number becomes NULL.
    """
    cleaned, _ = clean_readings(readings, grid, limit, encoding=fitted.encoding)
    table = feature_table(cleaned, grid, fitted.target)
    if since is not None:
        table = table.filter(F.col(grid.ts) >= F.lit(since).cast("timestamp_ntz"))
    return scaled_features(table, fitted, grid)


def scaled_features(table: DataFrame, fitted: Fitted, grid: Grid = Grid()) -> DataFrame:
    """The fitted features of a feature table, scaled; text read as numbers where it was."""
    bounds = {c: fitted.bounds[c] for c in fitted.features}
    typed = table.select(
        grid.series,
        grid.ts,
        *[
            F.expr(f"try_cast(`{c}` AS double)").alias(c) if c in fitted.texts else named(c)
            for c in fitted.features
        ],
    )
    return minmax_scale(typed, bounds)
