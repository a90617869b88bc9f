"""Model registry: versions with their runs, leaderboards, stages, promotions.

Versions carry ``version_id, name, version, run_id, aliases, created_at, description``;
the date is text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.functions.labels import DATE_ONLY, alias_status, has_alias, text_date_label
from tidegrid.operators.experiments import LEADERBOARD_SIZE, metric_columns
from tidegrid.operators.ranking import rank_groups

# The stages that have a list of their own.
STAGES = ("production", "staging")
NULL_SPREAD = 1_000


def registry_models(registry: DataFrame, runs: DataFrame) -> DataFrame:
    """Each version with the run that logged it and its metrics, or without.

    Versions without a run would all meet in one partition of the join, so each
    gets a key of its own choosing that matches nothing.
    """
    nobody = F.concat(
        F.lit("no-run\u0000"), F.pmod(F.xxhash64("version_id"), F.lit(NULL_SPREAD)).cast("string")
    )
    left = registry.withColumn("_run", F.coalesce(F.col("run_id").cast("string"), nobody))
    right = runs.select(
        F.col("run_id").cast("string").alias("_run"),
        F.col("name").alias("run_name"),
        F.col("state").alias("run_state"),
        F.col("created_at").alias("run_created_at"),
        *metric_columns(),
    )
    return left.join(right, "_run", "left").drop("_run")


def with_alias_status(registry: DataFrame) -> DataFrame:
    return registry.withColumn("status", alias_status(F.col("aliases"), F.col("version")))


def registry_summary(registry: DataFrame) -> DataFrame:
    """Number of versions, and of those aliased exactly production or staging."""
    return registry.agg(
        F.count_if(has_alias(F.col("aliases"), "production")).alias("production_models"),
        F.count_if(has_alias(F.col("aliases"), "staging")).alias("staging_models"),
        F.count(F.lit(1)).alias("total_versions"),
    )


def _by_accuracy() -> list:
    return [
        F.coalesce("single_step_accuracy", F.lit(0.0)).desc(),
        F.col("version_id").asc(),
    ]


def registry_leaderboard(models: DataFrame, size: int = LEADERBOARD_SIZE) -> DataFrame:
    """Best versions by single-step accuracy; missing counts as 0."""
    best = models.orderBy(*_by_accuracy()).limit(size)
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*_by_accuracy()))
    return with_alias_status(best.withColumn("rank", rank)).select(
        "rank",
        F.coalesce("run_name", F.lit("Unknown")).alias("model_name"),
        "version",
        "single_step_accuracy",
        "multi_step_accuracy",
        text_date_label(F.col("created_at"), DATE_ONLY).alias("created"),
        "status",
    )


def registry_by_stage(
    registry: DataFrame, runs: DataFrame, stages: Sequence[str] = STAGES
) -> DataFrame:
    """Versions with a stage's alias, ranked in each stage; only these meet their runs.

    Stages are few and may hold any number of versions, so they are ranked in ranges.
    """
    held = [F.when(has_alias(F.col("aliases"), s), F.lit(s)) for s in stages]
    staged = registry.withColumn("stage", F.explode(F.array_compact(F.array(*held))))
    return rank_groups(registry_models(staged, runs), "stage", _by_accuracy()).select(
        "stage",
        "rank",
        F.coalesce("run_name", F.lit("Unknown")).alias("model_name"),
        "version",
        "single_step_accuracy",
        "multi_step_accuracy",
        text_date_label(F.col("created_at"), DATE_ONLY).alias("created"),
    )


def _present(column: str):
    return F.coalesce(F.col(column) != "", F.lit(False))


def apply_promotions(registry: DataFrame, promotions: DataFrame) -> DataFrame:
    """Registry with the requested aliases appended.

    Requests carry ``name, version, target``. An alias a version already has is
    not added again; those it has stay as they are, in their order. Repeated requests are reduced to distinct ones first, so what
    is gathered per version is no longer than the list of alias names.
    """
    complete = promotions.filter(_present("name") & _present("version") & _present("target"))
    wanted = (
        complete.select("name", "version", "target")
        .distinct()
        .groupBy("name", "version")
        .agg(F.sort_array(F.collect_list("target")).alias("_targets"))
    )
    none = F.array().cast("array<string>")
    held, asked = F.coalesce("aliases", none), F.coalesce("_targets", none)
    appended = F.concat(held, F.array_except(asked, held))
    return (
        registry.join(wanted, ["name", "version"], "left")
        .withColumn("promoted", F.col("_targets").isNotNull())
        .withColumn("aliases", appended)
        .drop("_targets")
    )


def rejected_promotions(registry: DataFrame, promotions: DataFrame) -> DataFrame:
    """Requests that cannot be carried out, with the reason."""
    complete = _present("name") & _present("version") & _present("target")
    # one row per version, so that a popular one does not multiply
    known = registry.select("name", "version").distinct().withColumn("_known", F.lit(True))
    missing = promotions.filter(~complete).withColumn("reason", F.lit("incomplete request"))
    unknown = (
        promotions.filter(complete)
        .join(known, ["name", "version"], "left_anti")
        .withColumn("reason", F.lit("unknown version"))
    )
    return missing.unionByName(unknown)
