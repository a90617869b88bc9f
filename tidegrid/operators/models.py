"""Training of regressors on scaled feature tables and on sequences."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.grid import Grid
from tidegrid.operators.sequences import DEFAULT_LENGTH, sequence_windows

# Default size of the tree models and the seed.
TREES, DEPTH, SEED = 50, 10, 42
LABEL = "target"


def _forest(label: str, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> Estimator:
    return RandomForestRegressor(
        labelCol=label,
        featuresCol="features",
        numTrees=trees,
        maxDepth=depth,
        featureSubsetStrategy="all",
        seed=seed,
    )


def _boosting(label: str, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> Estimator:
    return GBTRegressor(
        labelCol=label,
        featuresCol="features",
        maxIter=trees,
        maxDepth=depth,
        stepSize=0.3,
        seed=seed,
    )


def _linear(label: str, reg: float = 0.0) -> Estimator:
    return LinearRegression(labelCol=label, featuresCol="features", regParam=reg)


TABULAR: dict[str, Callable[..., Estimator]] = {
    "random_forest": _forest,
    "xgboost": _boosting,
    "gbt": _boosting,
    "linear": _linear,
}
SEQUENCE = ("lstm", "sequence")


def estimator(name: str, label: str = LABEL, **params) -> Estimator:
    """The regressor of that name, in any case; others raise ``ValueError``."""
    build = TABULAR.get(name.lower())
    if build is None:
        raise ValueError(f"unsupported model: {name}")
    return build(label, **params)


def train_model(
    df: DataFrame,
    name: str,
    features: Sequence[str],
    label: str = LABEL,
    split: str = "split",
    **params,
) -> PipelineModel:
    """Fit a tabular model on the train rows."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    regressor = estimator(name, label, **params)
    train = df.filter(F.col(split) == "train").select(*features, label)
    return Pipeline(stages=[assembler, regressor]).fit(train)


def sequence_samples(
    df: DataFrame,
    features: Sequence[str],
    grid: Grid = Grid(),
    length: int = DEFAULT_LENGTH,
    split: str = "split",
    position: str = "split_row",
) -> DataFrame:
    """Windows of the rows before each row as one flat vector."""
    windows = sequence_windows(df, features, grid, length, split, position)
    return windows.withColumn("features", array_to_vector(F.flatten("window"))).drop("window")


def train_sequence_model(
    samples: DataFrame,
    label: str = LABEL,
    split: str = "split",
    trees: int = TREES,
    depth: int = 5,
    seed: int = SEED,
    patience: float = 0.01,
) -> PipelineModel:
    """Fit boosted trees on flattened windows, stopping early on the validation rows."""
    marked = samples.filter(F.col(split).isin("train", "val")).select(
        "features", label, (F.col(split) == "val").alias("is_validation")
    )
    regressor = GBTRegressor(
        labelCol=label,
        featuresCol="features",
        maxIter=trees,
        maxDepth=depth,
        stepSize=0.3,
        seed=seed,
        validationIndicatorCol="is_validation",
        validationTol=patience,
    )
    keep = SQLTransformer(statement="SELECT * FROM __THIS__")
    return Pipeline(stages=[keep, regressor]).fit(marked)


def train_staged(
    df: DataFrame,
    features: Sequence[str],
    label: str = LABEL,
    split: str = "split",
    trees: int = TREES,
    **params,
) -> tuple[PipelineModel, DataFrame]:
    """Boosted trees cut where the validation rows are predicted best.

    Returns the model and ``(trees, train_error, val_error, kept)``: the mean squared error
    of the first trees of the ensemble, for each number of them. Trees are added one after
    the other, so an ensemble fitted with fewer is the beginning of a longer one. Without
    validation rows nothing is cut.
    """
    whole = train_model(df, "gbt", features, label, split, trees=trees, **params)
    assembler, ensemble = whole.stages

    def errors(name: str) -> list[float] | None:
        part = df.filter(F.col(split) == name).select(*features, label)
        return ensemble.evaluateEachIteration(assembler.transform(part), "squared") if not part.isEmpty() else None

    train, val = errors("train"), errors("val")
    best = min(range(len(val)), key=val.__getitem__) + 1 if val else ensemble.getNumTrees
    rows = [(k, train[k - 1], val[k - 1] if val else None, k == best) for k in range(1, ensemble.getNumTrees + 1)]
    table = df.sparkSession.createDataFrame(rows, "trees int, train_error double, val_error double, kept boolean")
    if best == ensemble.getNumTrees:
        return whole, table
    return train_model(df, "gbt", features, label, split, trees=best, **params), table


def feature_importance(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per feature with its share of the fitted trees' gain."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(features, weights)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")
