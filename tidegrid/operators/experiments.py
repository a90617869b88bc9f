"""Leaderboards and summaries of experiment runs and their artifacts.

Runs carry ``run_id, name, state, created_at, user_id, tags, summary``, where the
summary is a struct as read by :func:`parse_summary`. Artifacts carry ``run_id,
name, version, type, seq``, with ``seq`` the order of logging.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.functions.labels import (
    accuracy_band,
    artifact_label,
    date_label,
    registration_label,
    runtime_label,
    state_label,
)
from tidegrid.session import settle

# Fixed values of the run report.
LEADERBOARD_SIZE = 10
PROBLEM_STATES = ("failed", "crashed", "killed")
PROBLEM_LIMIT = 5
UNREGISTERED_LIMIT = 5
HIGH_ACCURACY = 0.8
METRICS = ("accuracy", "mape", "mae")
SUMMARY_SCHEMA = (
    "single_step_metrics struct<accuracy double, mape double, mae double>, "
    "multi_step_metrics struct<accuracy double, mape double, mae double>, "
    "_runtime double"
)


def parse_summary(runs: DataFrame, text: str = "summary_json") -> DataFrame:
    """Read the JSON summary of each run into a ``summary`` struct."""
    return runs.withColumn("summary", F.from_json(text, SUMMARY_SCHEMA)).drop(text)


def metric_columns() -> list[Column]:
    summary = F.col("summary")
    columns = []
    for stage in ("single_step", "multi_step"):
        for metric in METRICS:
            columns.append(summary[f"{stage}_metrics"][metric].alias(f"{stage}_{metric}"))
    return [*columns, summary["_runtime"].alias("runtime")]


def run_metrics(runs: DataFrame) -> DataFrame:
    """Runs whose summary holds both groups of metrics, with the metrics as columns."""
    summary = F.col("summary")
    complete = (
        summary["single_step_metrics"].isNotNull() & summary["multi_step_metrics"].isNotNull()
    )
    rest = [c for c in runs.columns if c != "summary"]
    return runs.filter(complete).select(*rest, *metric_columns())


def filter_runs(
    runs: DataFrame, state: str | None = None, tags: Sequence[str] | None = None
) -> DataFrame:
    """Runs in a state and with any of the tags; no argument means no filter."""
    if state:
        runs = runs.filter(F.col("state") == state)
    if tags:
        wanted = F.array(*[F.lit(t) for t in tags])
        runs = runs.filter(F.arrays_overlap("tags", wanted))
    return runs


def artifact_counts(artifacts: DataFrame) -> DataFrame:
    """Per run: artifacts, models, and the first model by order of logging.

    Counts and a minimum only, so a run with very many artifacts is aggregated
    before the shuffle and never gathered.
    """
    model = F.col("type") == "model"
    first = F.min(F.when(model, F.struct("seq", "version", "name")))
    return artifacts.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("artifacts_count"),
        F.count_if(model).alias("model_artifacts"),
        first.alias("_first"),
    ).select(
        "run_id",
        "artifacts_count",
        "model_artifacts",
        F.col("_first")["name"].alias("first_model"),
        F.col("_first")["version"].alias("first_version"),
    )


def run_artifacts(runs: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Runs with their numbers of artifacts and models and a registration label."""
    joined = runs.join(artifact_counts(artifacts), "run_id", "left")
    return joined.select(
        *runs.columns,
        F.coalesce("artifacts_count", F.lit(0)).alias("artifacts_count"),
        F.coalesce("model_artifacts", F.lit(0)).alias("model_artifacts"),
        "first_model",
        "first_version",
    ).withColumn(
        "registration", registration_label(F.col("model_artifacts"), F.col("first_model"))
    )


def run_model_details(runs: DataFrame, artifacts: DataFrame) -> DataFrame:
    """The models of each run as rows ``(run_id, seq, detail)``, detail being name:version."""
    models = artifacts.filter(F.col("type") == "model").select(
        "run_id", "seq", F.concat_ws(":", "name", "version").alias("detail")
    )
    return models.join(runs.select("run_id").distinct(), "run_id", "left_semi")


def runs_summary(counted: DataFrame) -> DataFrame:
    """Totals over runs as given by :func:`run_artifacts`."""
    total = F.count(F.lit(1))
    registered = F.count_if(F.col("model_artifacts") > 0)
    return counted.agg(
        total.alias("total_runs"),
        F.count_if(F.col("state") == "finished").alias("finished_runs"),
        registered.alias("registered_runs"),
        F.bround(F.try_divide(registered * 100.0, total), 0).alias("registered_pct"),
        F.coalesce(F.sum("model_artifacts"), F.lit(0)).alias("total_models"),
    )


def runs_leaderboard(
    metrics: DataFrame, artifacts: DataFrame, size: int = LEADERBOARD_SIZE
) -> DataFrame:
    """Best runs by single-step accuracy (missing counts as 0), then newest, then id.

    The ranking does not need the artifacts: they are counted for the winners only.
    """
    order = [
        F.coalesce("single_step_accuracy", F.lit(0.0)).desc(),
        F.col("created_at").desc_nulls_last(),
        F.col("run_id").asc(),
    ]
    # at most `size` rows; settled, since they are used twice below
    best = settle(metrics.orderBy(*order).limit(size))
    theirs = artifacts.join(F.broadcast(best.select("run_id")), "run_id", "left_semi")
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))
    return run_artifacts(best.withColumn("rank", rank), theirs).select(
        "rank",
        "run_id",
        "name",
        "single_step_accuracy",
        "multi_step_accuracy",
        "model_artifacts",
        "state",
    )


def user_label() -> Column:
    return F.coalesce(F.col("user_id").cast("string"), F.lit("Unknown"))


def problem_runs(runs: DataFrame, limit: int = PROBLEM_LIMIT) -> DataFrame:
    """The first runs, by id, that did not end well, and how many more there are."""
    problems = runs.filter(F.col("state").isin(*PROBLEM_STATES))
    total = problems.agg(F.count(F.lit(1)).alias("_total"))
    # the first rows are few, the total is one row
    return problems.orderBy("run_id").limit(limit).join(F.broadcast(total)).select(
        "run_id",
        "name",
        "state",
        user_label().alias("user_id"),
        date_label(F.col("created_at")).alias("created"),
        F.greatest(F.col("_total") - limit, F.lit(0)).cast("bigint").alias("more_runs"),
    )


def unregistered_top_runs(
    metrics: DataFrame, artifacts: DataFrame, size: int = UNREGISTERED_LIMIT
) -> DataFrame:
    """Best runs above the accuracy threshold that have no model, and how many there are."""
    registered = artifacts.filter(F.col("type") == "model").select("run_id").distinct()
    high = metrics.filter(F.col("single_step_accuracy") > HIGH_ACCURACY)
    wanted = high.select("run_id", "name", "single_step_accuracy", "multi_step_accuracy", "user_id")
    # settled, since its best rows and its number of rows are both taken below, and each
    # would else read the runs, parse their summaries and look for models again
    bare = settle(wanted.join(registered, "run_id", "left_anti"))
    total = bare.agg(F.count(F.lit(1)).alias("total_runs"))
    return (
        bare.orderBy(F.desc("single_step_accuracy"), "run_id")
        .limit(size)
        .join(F.broadcast(total))
        .select(
            "run_id",
            "name",
            "single_step_accuracy",
            "multi_step_accuracy",
            user_label().alias("user_id"),
            "total_runs",
        )
    )


def run_labels(counted: DataFrame) -> DataFrame:
    """Labels of runs that carry metrics and artifact counts."""
    models = F.col("model_artifacts")
    return counted.select(
        "run_id",
        accuracy_band(F.col("single_step_accuracy")).alias("accuracy_band"),
        state_label(F.col("state")).alias("state_label"),
        runtime_label(F.col("runtime")).alias("runtime_label"),
        date_label(F.col("created_at")).alias("created_label"),
        registration_label(models, F.col("first_model")).alias("registration_label"),
        artifact_label(F.col("artifacts_count"), models).alias("artifact_label"),
    )


def run_paths(runs: DataFrame, entity: str, project: str, run_id: str = "run_id") -> DataFrame:
    """Full path of a run; an id that holds a slash is one already."""
    text = F.col(run_id).cast("string")
    path = F.concat_ws("/", F.lit(entity), F.lit(project), text)
    return runs.select(run_id, F.when(text.contains("/"), text).otherwise(path).alias("run_path"))


def registrable_models(runs: DataFrame, artifacts: DataFrame) -> DataFrame:
    """The model to register for each run, or why there is none."""
    joined = runs.select("run_id", "state").join(artifact_counts(artifacts), "run_id", "left")
    # a missing state is not "finished" either
    finished = F.coalesce(F.col("state") == "finished", F.lit(False))
    has_model = F.coalesce(F.col("model_artifacts") > 0, F.lit(False))
    return joined.select(
        "run_id",
        F.when(finished & has_model, F.col("first_model")).alias("model_name"),
        F.when(finished & has_model, F.col("first_version")).alias("model_version"),
        F.when(~finished, "run not finished")
        .when(~has_model, "no model artifacts")
        .otherwise("registrable")
        .alias("status"),
    )
