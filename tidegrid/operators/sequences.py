"""Sliding windows of feature rows with the row after them as target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.grid import Grid, named, own_rows, with_halo

DEFAULT_LENGTH = 24


def sequence_windows(
    df: DataFrame,
    features: Sequence[str],
    grid: Grid = Grid(),
    length: int = DEFAULT_LENGTH,
    split: str = "split",
    position: str = "split_row",
    output: str = "window",
) -> DataFrame:
    """Add to each row the ``length`` rows before it in its series and split.

    Rows with fewer rows before them are dropped: n rows give n - length samples.
    The window is an array of arrays of doubles, oldest row first. Neighbours are
    found by row position, so gaps in time do not matter.
    """
    if length < 1:
        raise ValueError("length must be positive")
    row = F.array(*[named(c).cast("double") for c in features])
    order = Window.partitionBy(grid.series, split, "_chunk").orderBy(position)
    haloed = with_halo(df, F.col(position), max(grid.chunk_cells, length), length)
    collected = F.collect_list(row).over(order.rowsBetween(-length, -1))
    return own_rows(
        haloed.withColumn(output, collected).filter(F.size(output) == length)
    )
