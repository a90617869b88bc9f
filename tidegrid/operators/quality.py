"""Data quality: sizes, missing values, duplicates, outliers, correlation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.quantiles import EXACT_LIMIT, exact_quantiles
from tidegrid.operators.moments import correlations, pair_moments

# Whisker length in interquartile ranges, digits of percentages.
WHISKER = 1.5
PERCENT_DIGITS = 2


def quality_summary(df: DataFrame, by: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and columns per dataset, where ``by`` names the dataset of a row."""
    width = len(columns) if columns is not None else len([c for c in df.columns if c != by])
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_rows"), F.lit(width).alias("total_columns")
    )


def missing_values(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """Count and percentage of missing values per column (and dataset)."""
    total = F.count(F.lit(1))
    aggregates = [(total - F.count(F.col(f"`{c}`"))).alias(f"_m{i}") for i, c in enumerate(columns)]
    keys = [by] if by else []
    counted = df.groupBy(*keys).agg(total.alias("_n"), *aggregates)
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing_count"))
            for i, c in enumerate(columns)
        ]
    )
    share = F.try_divide(F.col("e.missing_count"), F.col("_n")) * 100
    return counted.select(*keys, "_n", F.explode(entries).alias("e")).select(
        *keys, "e.column", "e.missing_count", F.round(share, PERCENT_DIGITS).alias("missing_pct")
    )


def duplicate_rows(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """Rows equal to an earlier one in all ``columns``; missing equals missing."""
    keys = [by] if by else []
    distinct = df.groupBy(*keys, *columns).agg(F.count(F.lit(1)).alias("_n"))
    return distinct.groupBy(*keys).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows")
    )


def dtype_counts(df: DataFrame) -> dict[str, int]:
    """Number of columns per data type."""
    counts: dict[str, int] = {}
    for _, dtype in df.dtypes:
        counts[dtype] = counts.get(dtype, 0) + 1
    return counts


def outlier_bounds(
    df: DataFrame, measures: Mapping[str, Column], limit: int = EXACT_LIMIT
) -> dict[str, tuple[float | None, float | None, float | None, float | None]]:
    """Per measure: lower bound, first quartile, third quartile, upper bound."""
    bounds = {}
    for name, (q1, q3) in exact_quantiles(df, measures, (0.25, 0.75), limit).items():
        if q1 is None:
            bounds[name] = (None, None, None, None)
        else:
            reach = WHISKER * (q3 - q1)
            bounds[name] = (q1 - reach, q1, q3, q3 + reach)
    return bounds


def iqr_outliers(
    df: DataFrame,
    columns: Sequence[str],
    by: str | None = None,
    groups: Sequence[str] = (),
    limit: int = EXACT_LIMIT,
) -> DataFrame:
    """Values strictly outside 1.5 interquartile ranges, per column (and dataset).

    Quantiles and counts are aggregates over the columns as they are; the table is
    not turned into one row per value.
    """
    measures, labels = {}, []
    for group in groups if by else [None]:
        for c in columns:
            value = F.col(f"`{c}`").cast("double")
            key = f"{len(labels)}"
            measures[key] = value if group is None else F.when(F.col(by) == group, value)
            labels.append((key, group, c))
    bounds = outlier_bounds(df, measures, limit)
    entries = []
    for key, group, c in labels:
        low, q1, q3, high = bounds[key]
        outside = (
            F.lit(False) if low is None else (measures[key] < low) | (measures[key] > high)
        )
        entries.append(
            F.struct(
                F.lit(group).alias("_group"),
                F.lit(c).alias("column"),
                F.lit(q1).cast("double").alias("q1"),
                F.lit(q3).cast("double").alias("q3"),
                F.count_if(outside).alias("outliers"),
            ).alias(f"_{key}")
        )
    counted = df.agg(*entries)
    rows = F.explode(F.array(*[F.col(f"_{key}") for key, _, _ in labels])).alias("e")
    named = [F.col("e._group").alias(by)] if by else []
    return counted.select(rows).select(*named, "e.column", "e.q1", "e.q3", "e.outliers")


def clip_outliers(df: DataFrame, columns: Sequence[str], limit: int = EXACT_LIMIT) -> DataFrame:
    """Clip columns to their outlier bounds. Off unless asked for."""
    bounds = outlier_bounds(df, {c: F.col(f"`{c}`").cast("double") for c in columns}, limit)

    def clipped(c: str) -> Column:
        low, _, _, high = bounds[c]
        value = F.col(f"`{c}`").cast("double")
        if low is None:
            return value.alias(c)
        return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high))).alias(c)

    return df.select(*[clipped(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of all pairs over the rows where both are present.

    A column that is constant on these rows has no correlation (NULL). Tables of any
    width are read once (see :mod:`tidegrid.operators.moments`).
    """
    return correlations(pair_moments(df, columns), columns)
