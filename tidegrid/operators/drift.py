"""Comparison of train and test data: drift, target statistics, distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.quantiles import EXACT_LIMIT, exact_quantiles
from tidegrid.operators.quality import WHISKER
from tidegrid.operators.scoring import histogram

# Changes in percent above which drift or a target shift is reported.
MEAN_DRIFT, STD_DRIFT, TARGET_SHIFT = 20.0, 30.0, 15.0
DENSITY_BINS = 30
DATASETS = ("train", "test")


def _in(split: str, name: str, column: str) -> Column:
    return F.when(F.col(split) == name, F.col(f"`{column}`").cast("double"))


def _change(test: Column, train: Column) -> Column:
    """Change in percent of the train value; 0 when that is 0."""
    return F.when(train == 0, F.lit(0.0)).otherwise(
        F.abs(F.try_divide(test - train, train) * 100)
    )


def drift_report(df: DataFrame, columns: Sequence[str], split: str = "split") -> DataFrame:
    """Mean and standard deviation of each column in train and test, and their change."""
    aggregates = []
    for i, c in enumerate(columns):
        for name in DATASETS:
            aggregates.append(F.avg(_in(split, name, c)).alias(f"{name}_mean{i}"))
            aggregates.append(F.stddev_samp(_in(split, name, c)).alias(f"{name}_std{i}"))
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                *[
                    F.col(f"{name}_{stat}{i}").alias(f"{name}_{stat}")
                    for stat in ("mean", "std")
                    for name in DATASETS
                ],
            )
            for i, c in enumerate(columns)
        ]
    )
    return drift_of(df.agg(*aggregates).select(F.explode(entries).alias("e")).select("e.*"))


def drift_of(compared: DataFrame) -> DataFrame:
    """The report from means and standard deviations of each column in train and test."""
    changed = compared.select(
        "*",
        _change(F.col("test_mean"), F.col("train_mean")).alias("mean_change_pct"),
        _change(F.col("test_std"), F.col("train_std")).alias("std_change_pct"),
    )
    drifted = F.coalesce(F.col("mean_change_pct") > MEAN_DRIFT, F.lit(False)) | F.coalesce(
        F.col("std_change_pct") > STD_DRIFT, F.lit(False)
    )
    return changed.withColumn("drift_detected", drifted)


def drift_summary(report: DataFrame) -> DataFrame:
    """Number and names of drifted columns (one entry per column of the table)."""
    name = F.when(F.col("drift_detected"), F.col("column"))
    return report.agg(
        F.count(name).alias("drifted_columns"),
        F.count(F.lit(1)).alias("checked_columns"),
        F.array_join(F.sort_array(F.collect_list(name)), ", ").alias("drifted_names"),
    )


def target_stats(df: DataFrame, target: str, split: str = "split") -> DataFrame:
    """Mean, standard deviation, minimum and maximum of the target per dataset."""
    value = F.col(f"`{target}`").cast("double")
    return (
        df.filter(F.col(split).isin(*DATASETS))
        .groupBy(split)
        .agg(
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )
    )


def target_shift(df: DataFrame, target: str, split: str = "split") -> DataFrame:
    """Change of the target's mean in percent, with an alert above the threshold."""
    return shift_of(df.agg(*[F.avg(_in(split, n, target)).alias(f"{n}_mean") for n in DATASETS]))


def shift_of(means: DataFrame) -> DataFrame:
    """The shift from the target's means."""
    shift = F.abs(
        F.try_divide(F.col("test_mean") - F.col("train_mean"), F.col("train_mean")) * 100
    )
    return means.withColumn("shift_pct", shift).withColumn(
        "alert", F.coalesce(F.col("shift_pct") > TARGET_SHIFT, F.lit(False))
    )


def target_histogram(
    df: DataFrame, target: str, split: str = "split", bins: int = DENSITY_BINS
) -> DataFrame:
    """Density of the target in train and test, each over its own range."""
    return histogram(df, target, bins, by=split, groups=DATASETS)


def target_boxplot(
    df: DataFrame, target: str, split: str = "split", limit: int = EXACT_LIMIT
) -> DataFrame:
    """Quartiles, whiskers (furthest value within 1.5 IQR) and outlier counts."""
    measures = {n: _in(split, n, target) for n in DATASETS}
    quartiles = exact_quantiles(df, measures, (0.25, 0.5, 0.75), limit)
    entries = []
    for name in DATASETS:
        q1, median, q3 = quartiles[name]
        if q1 is None:
            continue
        value, reach = measures[name], WHISKER * (q3 - q1)
        low, high = q1 - reach, q3 + reach
        entries.append(
            F.struct(
                F.lit(name).alias(split),
                F.lit(q1).alias("q1"),
                F.lit(median).alias("median"),
                F.lit(q3).alias("q3"),
                # a whisker never ends inside the box
                F.least(F.min(F.when(value >= low, value)), F.lit(q1)).alias("whisker_low"),
                F.greatest(F.max(F.when(value <= high, value)), F.lit(q3)).alias("whisker_high"),
                F.count_if((value < low) | (value > high)).alias("outliers"),
            ).alias(name)
        )
    names = [n for n in DATASETS if quartiles[n][0] is not None]
    return (
        df.agg(*entries)
        .select(F.explode(F.array(*[F.col(n) for n in names])).alias("e"))
        .select("e.*")
    )
