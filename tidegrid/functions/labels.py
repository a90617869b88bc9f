"""Scalar labels of runs and registry versions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower ends of the accuracy bands, and the known run states.
ACCURACY_BANDS = (
    (0.95, "champion"),
    (0.90, "gold"),
    (0.85, "silver"),
    (0.80, "bronze"),
    (0.70, "fair"),
)
RUN_STATES = ("finished", "running", "failed", "crashed", "killed", "preempted")
DATE_TIME, DATE_ONLY = "yyyy-MM-dd HH:mm", "yyyy-MM-dd"


def accuracy_band(accuracy: Column) -> Column:
    band = F.when(accuracy.isNull(), "unknown")
    for lower, name in ACCURACY_BANDS:
        band = band.when(accuracy >= lower, name)
    return band.otherwise("low")


def state_label(state: Column) -> Column:
    return F.when(state.isin(*RUN_STATES), state).otherwise("unknown")


def runtime_label(seconds: Column) -> Column:
    """Seconds, minutes or hours with one decimal."""
    return (
        F.when(seconds.isNull(), "N/A")
        .when(seconds < 60, F.format_string("%.1fs", seconds))
        .when(seconds < 3600, F.format_string("%.1fm", seconds / 60))
        .otherwise(F.format_string("%.1fh", seconds / 3600))
    )


def date_label(value: Column, pattern: str = DATE_TIME) -> Column:
    return F.coalesce(F.date_format(value, pattern), F.lit("Unknown"))


def text_date_label(text: Column, pattern: str = DATE_TIME) -> Column:
    """Format ISO text; text that is no date is shown as it is."""
    parsed = text.try_cast("timestamp_ntz")
    empty = text.isNull() | (text == "")
    return F.when(empty, "Unknown").otherwise(F.coalesce(F.date_format(parsed, pattern), text))


def registration_label(models: Column, model_name: Column) -> Column:
    return (
        F.when(models == 0, "not registered")
        .when(models == 1, F.concat(F.lit("registered (1 model: "), model_name, F.lit(")")))
        .otherwise(F.format_string("registered (%d models)", models))
    )


def artifact_label(artifacts: Column, models: Column) -> Column:
    return (
        F.when(artifacts == 0, "not registered")
        .when(models > 0, F.format_string("registered (%d models, %d total)", models, artifacts))
        .otherwise(F.format_string("registered (%d artifacts, no models)", artifacts))
    )


def alias_status(aliases: Column, version: Column) -> Column:
    """Deployment status from aliases; the version where there are none."""
    lowered = F.transform(aliases, F.lower)

    def mentions(word: str) -> Column:
        return F.exists(lowered, lambda a: a.contains(word))

    latest = F.exists(
        lowered,
        lambda a: a.contains("latest") & ~a.contains("staging") & ~a.contains("production"),
    )
    parts = F.array(
        F.when(mentions("production"), "production"),
        F.when(mentions("staging"), "staging"),
        F.when(latest, "latest"),
    )
    none = aliases.isNull() | (F.size(aliases) == 0)
    return F.when(none, version).otherwise(F.array_join(F.array_compact(parts), ", "))


def has_alias(aliases: Column, alias: str) -> Column:
    """Whether an alias equals the given one, in any case."""
    return F.coalesce(F.array_contains(F.transform(aliases, F.lower), alias), F.lit(False))
