"""The whole monitoring report as a set of tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.quantiles import exact_quantiles
from tidegrid.grid import named
from tidegrid.operators.drift import DATASETS, DENSITY_BINS, drift_of, drift_summary, shift_of
from tidegrid.operators.moments import column_moments, correlations, pair_moments
from tidegrid.operators.quality import PERCENT_DIGITS, WHISKER, dtype_counts, duplicate_rows
from tidegrid.operators.scoring import histogram_of, histogram_place
from tidegrid.session import settle


def monitoring_report(
    df: DataFrame, features: Sequence[str], target: str, split: str = "split"
) -> dict[str, DataFrame]:
    """Drift, target and quality tables of train against test rows.

    Besides the quantiles, ``df`` is read three times: for moments, extremes and products
    of all columns, from which drift, target, missing values and correlation are read; for
    the counts of outliers and bins, once quartiles and ranges are known; and for
    duplicates, whose rows have to meet.
    """
    spark = df.sparkSession
    columns = [*features, target]
    both = df.filter(F.col(split).isin(*DATASETS))
    pairs = pair_moments(both, columns, split, DATASETS)
    facts = settle(column_moments(pairs, columns))
    mine = facts.filter(F.col("column") == target)
    kinds = dtype_counts(df.select(*map(named, columns)))
    drift = drift_of(_side_by_side(facts, columns))
    means = mine.agg(*[F.max(F.when(F.col("grp") == n, F.col("mean"))).alias(f"{n}_mean") for n in DATASETS])
    share = F.try_divide(F.col("total") - F.col("n"), F.col("total")) * 100
    return {
        "drift": drift,
        "drift_summary": drift_summary(drift),
        "target_stats": mine.select(F.col("grp").alias(split), "mean", "std", F.col("lo").alias("min"), F.col("hi").alias("max")),
        "target_shift": shift_of(means),
        "quality": mine.select(F.col("grp").alias(split), F.col("total").alias("total_rows"), F.lit(len(columns)).alias("total_columns")),
        "dtypes": spark.createDataFrame(list(kinds.items()), "dtype string, columns int"),
        "missing": facts.select(
            F.col("grp").alias(split),
            "column",
            (F.col("total") - F.col("n")).alias("missing_count"),
            F.round(share, PERCENT_DIGITS).alias("missing_pct"),
        ),
        "duplicates": duplicate_rows(both, columns, by=split),
        **_counted(both, columns, target, split, mine),
        "correlation": correlations(pairs, columns, "train"),
    }


def _side_by_side(facts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with the means and standard deviations of both datasets."""
    sides = [
        F.max(F.when(F.col("grp") == name, F.col(stat))).alias(f"{name}_{stat}")
        for stat in ("mean", "std")
        for name in DATASETS
    ]
    names = facts.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(facts.groupBy("column").agg(*sides), "column", "left")


def _counted(both: DataFrame, columns: Sequence[str], target: str, split: str, mine: DataFrame) -> dict[str, DataFrame]:
    """Outliers, histogram and box plot from one pass, a row per dataset and bin of the target."""
    cells = {(g, c): named(c).cast("double") for g in DATASETS for c in columns}
    keys = {cell: f"{i}" for i, cell in enumerate(cells)}
    measures = {keys[g, c]: F.when(F.col(split) == g, v) for (g, c), v in cells.items()}
    quartiles = exact_quantiles(both, measures, (0.25, 0.5, 0.75))
    # one row per dataset
    found = {r["grp"]: (r["lo"], r["hi"], r["n"]) for r in mine.collect()}
    ranges = {g: found.get(g, (None, None, 0)) for g in DATASETS}
    value = named(target).cast("double")
    part, place = histogram_place(value, DENSITY_BINS, split, ranges)
    aggregates, fences = [F.count(value).alias("n")], {}
    for cell, key in keys.items():
        q1, _, q3 = quartiles[key]
        if q1 is not None:
            reach = WHISKER * (q3 - q1)
            fences[cell] = low, high = q1 - reach, q3 + reach
            aggregates.append(F.count_if((measures[key] < low) | (measures[key] > high)).alias(f"o{key}"))
            if cell[1] == target:
                aggregates.append(F.min(F.when(measures[key] >= low, measures[key])).alias(f"lo{key}"))
                aggregates.append(F.max(F.when(measures[key] <= high, measures[key])).alias(f"hi{key}"))
    counted = settle(both.groupBy(part.alias("_part"), place.alias("bin")).agg(*aggregates))

    def outside(cell: tuple[str, str]):
        return F.coalesce(F.sum(f"o{keys[cell]}"), F.lit(0)) if cell in fences else F.lit(0).cast("long")

    outliers = [
        F.struct(
            F.lit(g).alias(split),
            F.lit(c).alias("column"),
            F.lit(quartiles[keys[g, c]][0]).cast("double").alias("q1"),
            F.lit(quartiles[keys[g, c]][2]).cast("double").alias("q3"),
            outside((g, c)).alias("outliers"),
        )
        for g, c in cells
    ]
    boxes = []
    for g in DATASETS:
        if (g, target) in fences:
            key = keys[g, target]
            q1, median, q3 = quartiles[key]
            boxes.append(
                F.struct(
                    F.lit(g).alias(split),
                    F.lit(q1).alias("q1"),
                    F.lit(median).alias("median"),
                    F.lit(q3).alias("q3"),
                    # a whisker never ends inside the box
                    F.least(F.min(f"lo{key}"), F.lit(q1)).alias("whisker_low"),
                    F.greatest(F.max(f"hi{key}"), F.lit(q3)).alias("whisker_high"),
                    outside((g, target)).alias("outliers"),
                )
            )

    def rows(entries: list) -> DataFrame:
        kept = [e.alias(f"_{i}") for i, e in enumerate(entries)]
        return counted.agg(*kept).select(F.explode(F.array(*[F.col(f"_{i}") for i in range(len(kept))])).alias("e")).select("e.*")

    bins = counted.filter("_part IS NOT NULL AND bin IS NOT NULL").select("_part", "bin", "n")
    empty = "q1 double, median double, q3 double, whisker_low double, whisker_high double, outliers bigint"
    return {
        "outliers": rows(outliers),
        "histogram": histogram_of(bins, DENSITY_BINS, split, ranges),
        "boxplot": rows(boxes) if boxes else both.sparkSession.createDataFrame([], f"{split} string, {empty}"),
    }


def report_long(tables: dict[str, DataFrame], split: str = "split") -> DataFrame:
    """The numbers of the report in one table ``(section, dataset, item, measure, value)``."""

    def melt(section: str, item: str | None, measures: Sequence[str]) -> DataFrame:
        df = tables[section]
        dataset = F.col(split) if split in df.columns else F.lit(None).cast("string")
        entries = F.array(
            *[
                F.struct(
                    F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")
                )
                for m in measures
            ]
        )
        return df.select(
            F.lit(section).alias("section"),
            dataset.alias("dataset"),
            (F.col(item).cast("string") if item else F.lit(None).cast("string")).alias("item"),
            F.explode(entries).alias("e"),
        ).select("section", "dataset", "item", "e.measure", "e.value")

    parts = [
        melt("drift", "column", ("mean_change_pct", "std_change_pct", "drift_detected")),
        melt("drift_summary", None, ("drifted_columns", "checked_columns")),
        melt("target_stats", None, ("mean", "std", "min", "max")),
        melt("target_shift", None, ("shift_pct", "alert")),
        melt("quality", None, ("total_rows", "total_columns")),
        melt("dtypes", "dtype", ("columns",)),
        melt("missing", "column", ("missing_count", "missing_pct")),
        melt("duplicates", None, ("duplicate_rows",)),
        melt("outliers", "column", ("q1", "q3", "outliers")),
        melt("histogram", "bin", ("n", "density")),
        melt("boxplot", None, ("q1", "median", "q3", "whisker_low", "whisker_high", "outliers")),
    ]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    correlation = tables["correlation"].select(
        F.lit("correlation").alias("section"),
        F.lit("train").alias("dataset"),
        F.concat_ws(" ~ ", "column_a", "column_b").alias("item"),
        F.lit("correlation").alias("measure"),
        F.col("correlation").alias("value"),
    )
    return table.unionByName(correlation)
