"""Row positions in time, and time-ordered splits and folds built on them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.grid import Grid, named
from tidegrid.session import join_counted, settle

# Default shares of train, validation and test rows.
DEFAULT_RATIOS = (0.7, 0.1, 0.2)
DEFAULT_FOLDS = 5


def check_ratios(train: float, val: float, test: float) -> None:
    if not math.isclose(train + val + test, 1.0, rel_tol=1e-5, abs_tol=1e-8):
        raise ValueError("train, validation and test ratios must sum to 1")


def with_positions(df: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Add ``_row`` (from 1, by time) and ``_rows`` (their number) within each series.

    Rows are numbered inside their chunk and shifted by the count of the chunks
    before, which is a window over one row per series and chunk; that small table is
    computed at once and broadcast if its count allows. The frame is read twice (once
    for the counts), so pass a settled one if it is costly.
    """
    keyed = df.withColumn("_chunk", grid.chunk(grid.cell()))
    earlier = Window.partitionBy(grid.series).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        keyed.groupBy(grid.series, "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            grid.series,
            "_chunk",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_n").over(Window.partitionBy(grid.series)).alias("_rows"),
        )
    )
    within = F.row_number().over(Window.partitionBy(grid.series, "_chunk").orderBy(grid.ts))
    return (
        join_counted(keyed, settle(offsets), [grid.series, "_chunk"])
        .withColumn("_row", F.col("_before") + within)
        .drop("_chunk", "_before")
    )


def time_split(
    df: DataFrame,
    grid: Grid = Grid(),
    ratios: tuple[float, float, float] = DEFAULT_RATIOS,
) -> DataFrame:
    """Label rows train, val or test by time; ``split_row`` counts from 1 in each split.

    Of ``n`` rows of a series the first ``int(n * train)`` are train, the next
    ``int(n * val)`` validation and the rest test.
    """
    check_ratios(*ratios)
    train, val, _ = ratios
    n_train = F.floor(F.col("_rows") * F.lit(float(train)))
    n_val = F.floor(F.col("_rows") * F.lit(float(val)))
    row = F.col("_row")
    placed = with_positions(df, grid)
    return placed.select(
        *map(named, df.columns),
        F.when(row <= n_train, "train").when(row <= n_train + n_val, "val").otherwise("test")
        .alias("split"),
        F.when(row <= n_train, row)
        .when(row <= n_train + n_val, row - n_train)
        .otherwise(row - n_train - n_val)
        .alias("split_row"),
    )


def cv_folds(df: DataFrame, grid: Grid = Grid(), n_splits: int = DEFAULT_FOLDS) -> DataFrame:
    """Expanding-window folds: fold k trains on the tiles up to k and validates on k+1.

    The rows of a series are cut by time into ``n_splits + 1`` tiles whose sizes
    differ by at most one, the larger ones first.
    """
    if n_splits < 1:
        raise ValueError("n_splits must be at least 1")
    tile = _tile(F.col("_row") - 1, F.col("_rows"), n_splits + 1)
    # a row of tile t validates fold t - 1 and trains folds t and above
    fold = F.explode(F.sequence(F.greatest(tile - 1, F.lit(1)), F.lit(n_splits).cast("bigint")))
    return (
        with_positions(df, grid)
        .select(*map(named, df.columns), tile.alias("_tile"), fold.alias("fold"))
        .select(
            *map(named, df.columns),
            F.col("fold").cast("int").alias("fold"),
            F.when(F.col("_tile") <= F.col("fold"), "train").otherwise("val").alias("role"),
        )
    )


def _tile(index: Column, rows: Column, tiles: int) -> Column:
    size = F.floor(rows / F.lit(tiles))
    larger = rows % tiles
    in_larger = larger * (size + 1)
    rank = F.when(index < in_larger, F.floor(F.try_divide(index, size + 1))).otherwise(
        larger + F.floor(F.try_divide(index - in_larger, size))
    )
    return (rank + 1).cast("bigint")
