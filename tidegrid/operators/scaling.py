"""Choice of feature columns and min-max scaling fitted on train rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.grid import named

# Fixed value: strings with at most this many distinct values may become features.
MAX_TEXT_VALUES = 10

Bounds = Mapping[str, tuple[float | None, float | None]]


def select_features(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Cast usable columns to numbers and name the features.

    Numbers and booleans are used as they are; a string column with few distinct
    values is used when any of them reads as a number, and unreadable values
    become NULL. All string columns are judged in one pass.
    """
    fields = [f for f in df.schema.fields if f.name not in exclude]
    texts = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    usable: set[str] = set()
    if texts:
        checks = []
        for i, c in enumerate(texts):
            checks.append(F.approx_count_distinct(c, 0.02).alias(f"n{i}"))
            checks.append(F.count(F.expr(f"try_cast(`{c}` AS double)")).alias(f"v{i}"))
        found = df.agg(*checks).first()
        # the sketch is exact enough to rule columns out; the rest are counted
        likely = [
            c for i, c in enumerate(texts) if found[f"v{i}"] and found[f"n{i}"] <= 2 * MAX_TEXT_VALUES
        ]
        if likely:
            counts = df.agg(*[F.count_distinct(F.col(f"`{c}`")) for c in likely]).first()
            usable = {c for c, n in zip(likely, counts) if n <= MAX_TEXT_VALUES}
    features, columns = [], []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if f.name not in exclude:
            if isinstance(f.dataType, T.BooleanType):
                column = column.cast("int").alias(f.name)
                features.append(f.name)
            elif f.name in usable:
                column = F.expr(f"try_cast(`{f.name}` AS double)").alias(f.name)
                features.append(f.name)
            elif isinstance(f.dataType, T.NumericType):
                features.append(f.name)
        columns.append(column)
    return df.select(*columns), features


def minmax_fit(df: DataFrame, columns: Sequence[str], split: str = "split") -> DataFrame:
    """Table ``(column, min, max)`` over the train rows, in one pass."""
    train = df.filter(F.col(split) == "train")
    ends = train.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.min(named(c)).cast("double").alias("min"),
                F.max(named(c)).cast("double").alias("max"),
            ).alias(f"_{i}")
            for i, c in enumerate(columns)
        ]
    )
    rows = F.explode(F.array(*[F.col(f"_{i}") for i in range(len(columns))]))
    return ends.select(rows.alias("r")).select("r.*")


def read_bounds(scaling: DataFrame) -> dict[str, tuple[float | None, float | None]]:
    """The fitted table as a mapping: one row per column, so small by construction."""
    return {r["column"]: (r["min"], r["max"]) for r in scaling.collect()}


def bounds_table(spark: SparkSession, bounds: Bounds) -> DataFrame:
    rows = [(c, lo, hi) for c, (lo, hi) in bounds.items()]
    return spark.createDataFrame(rows, "column string, min double, max double")


def scaled(value: Column, lo: float | None, hi: float | None) -> Column:
    """(x - min) / (max - min); x - min for a constant column; no clipping."""
    if lo is None or hi is None:
        return F.lit(None).cast("double")
    shifted = value.cast("double") - F.lit(lo)
    return shifted if hi == lo else shifted / F.lit(hi - lo)


def unscaled(value: Column, lo: float, hi: float) -> Column:
    """Back to original units; a constant column was only shifted."""
    return value * F.lit(hi - lo if hi != lo else 1.0) + F.lit(lo)


def minmax_scale(df: DataFrame, bounds: Bounds, suffix: str = "") -> DataFrame:
    """Scale the columns named in ``bounds``, in place or next to them with a suffix."""
    if suffix:
        added = [scaled(named(c), *b).alias(c + suffix) for c, b in bounds.items()]
        return df.select("*", *added)
    return df.select(
        *[scaled(named(c), *bounds[c]).alias(c) if c in bounds else named(c) for c in df.columns]
    )


def minmax_unscale(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Columns scaled by :func:`minmax_scale` in place, back in original units."""
    return df.select(
        *[
            unscaled(named(c), *bounds[c]).alias(c) if c in bounds and bounds[c][0] is not None else named(c)
            for c in df.columns
        ]
    )


def minmax_inverse(
    df: DataFrame, column: str, bounds: tuple[float, float], output: str
) -> DataFrame:
    return df.withColumn(output, unscaled(named(column), *bounds))
