"""From raw readings to a gap-free table on the grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.grid import Grid, named
from tidegrid.operators.encoding import encode, rank_labels, weather_column
from tidegrid.operators.gaps import DEFAULT_LIMIT, fill_seasonal, interpolate
from tidegrid.operators.naming import drop_columns
from tidegrid.operators.regrid import (
    chunk_summary,
    extent_of,
    label_of,
    nan_to_null,
    numeric_columns,
    snap_regular_offset,
)
from tidegrid.session import settle
from tidegrid.sources.readings import as_series


def clean_readings(
    raw: DataFrame,
    grid: Grid = Grid(),
    limit: int = DEFAULT_LIMIT,
    encoding: DataFrame | None = None,
    columns: Sequence[str] | None = None,
    snap: bool = True,
) -> tuple[DataFrame, DataFrame | None]:
    """Drop unwanted columns, regrid, encode the weather code and fill gaps.

    Returns the cleaned table and the encoding used: the given one, or one fitted
    on this table where it has a weather column. The readings are read twice: for a
    summary by chunk, which tells shifted series, holes, labels and the values next
    to a chunk, and to be laid on the grid. Labels of shifted series, which are on
    the grid only once they are moved, take a third reading where there are any.
    """
    readings = nan_to_null(drop_columns(raw))
    weather = weather_column(readings.columns)
    keys = (grid.series, grid.ts, weather)
    numeric = list(columns) if columns else numeric_columns(readings, exclude=keys)
    readings = readings.select(
        *[named(c).cast("double").alias(c) if c in numeric else named(c) for c in readings.columns]
    )
    fit = weather is not None and encoding is None
    found = settle(chunk_summary(readings, grid, numeric, weather if fit else None))
    summary = found.filter(F.col(grid.series).isNotNull())
    extents = extent_of(summary, grid)
    hole = (F.col("on_grid") < F.col("hi") - F.col("lo") + 1) & ~F.col("shifted")
    facts = extents.agg(F.count_if("shifted").alias("shifted"), F.count_if(hole).alias("with_holes")).first()
    labels = found.filter(F.col("_label").isNotNull()).select(F.col("_label").alias("label")) if fit else None
    if snap and facts["shifted"]:
        extents = settle(extents)
        readings = snap_regular_offset(readings, grid, extents, facts["shifted"])
        moved = extents.filter("shifted").select(grid.series, F.lit(True).alias("_moved"))
        if fit:
            shifted = readings.join(moved, grid.series, "left_semi")
            labels = labels.unionByName(shifted.select(label_of(weather).alias("label"))).distinct()
        now_on = F.col("_on") | F.coalesce("_moved", F.lit(False))
        summary = summary.join(moved, grid.series, "left").withColumn("_on", now_on).drop("_moved")
    if fit:
        # holes of the grid count as missing labels
        encoding = rank_labels(labels, with_missing=facts["with_holes"] > 0)
    filled = interpolate(readings, numeric, grid, limit, summary)
    if weather:
        filled = encode(filled, weather, encoding)
    return fill_seasonal(filled, numeric, grid), encoding


def clean_raw(
    raw: DataFrame,
    grid: Grid = Grid(),
    limit: int = DEFAULT_LIMIT,
    time: str = "time",
    series: str | None = None,
    encoding: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """:func:`clean_readings` of a table as it was delivered: names and times repaired first.

    Names lose empty units and spaces; times may be text, unreadable ones are dropped.
    """
    return clean_readings(as_series(raw, time, series, grid.ts, grid.series), grid, limit, encoding)
