"""The regular time grid every time-ordered operator works on.

A window ordered by time over one whole series would put that series on one
core, so each operator partitions by ``(series, chunk)`` instead, where a chunk
is a run of ``chunk_cells`` grid cells. Chunk numbers come from the timestamp
alone: they are the same on every retry and need no count of the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def named(column: str) -> Column:
    """The column of exactly that name, dots and spaces included."""
    return F.col(f"`{column}`")


@dataclass(frozen=True)
class Grid:
    """Names of the key columns, the step of the grid and the chunk length.

    ``freq_seconds`` has to divide a day, so that cells line up with midnight.
    """

    series: str = "series_id"
    ts: str = "ts"
    freq_seconds: int = 3_600
    chunk_cells: int = 1_024

    def __post_init__(self) -> None:
        if self.freq_seconds <= 0 or DAY_SECONDS % self.freq_seconds:
            raise ValueError("freq_seconds must divide one day")
        if self.chunk_cells < 1:
            raise ValueError("chunk_cells must be positive")

    # Expressions are SQL text: one call instead of dozens to build them.

    def _cell_sql(self, ts: str) -> str:
        per_day = DAY_SECONDS // self.freq_seconds
        # only the parts of a time that tell its cell
        if self.freq_seconds % 3_600 == 0:
            in_day, unit = f"hour(`{ts}`)", 3_600
        elif self.freq_seconds % 60 == 0:
            in_day, unit = f"(hour(`{ts}`) * 60 + minute(`{ts}`))", 60
        else:
            in_day, unit = f"(hour(`{ts}`) * 3600 + minute(`{ts}`) * 60 + second(`{ts}`))", 1
        return f"(unix_date(to_date(`{ts}`)) * {per_day}L + {in_day} div {self.freq_seconds // unit})"

    def _time_sql(self, cell: str) -> str:
        return f"(TIMESTAMP_NTZ'1970-01-01 00:00:00' + {cell} * INTERVAL '{self.freq_seconds}' SECOND)"

    def cell(self, ts: str | None = None) -> Column:
        """Number of the grid cell a timestamp falls into (floored)."""
        return F.expr(self._cell_sql(ts or self.ts))

    def time_of(self, cell: str) -> Column:
        """Start of the cell with the number in column ``cell``, without time zone."""
        return F.expr(self._time_sql(f"`{cell}`"))

    def floor(self, ts: str | None = None) -> Column:
        """Start of the cell a timestamp falls into."""
        return F.expr(self._time_sql(self._cell_sql(ts or self.ts)))

    def chunk(self, cell: Column) -> Column:
        return F.floor(cell / F.lit(self.chunk_cells))

    def offset(self) -> Column:
        """How far a timestamp lies after the start of its cell, to the microsecond."""
        return F.col(self.ts).cast("timestamp_ntz") - self.floor()

    def on_grid(self) -> Column:
        """Whether a timestamp is the start of its cell."""
        return F.col(self.ts).cast("timestamp_ntz") == self.floor()


def with_halo(
    df: DataFrame, position: Column, chunk_len: int, look_back: int, chunk: str = "_chunk"
) -> DataFrame:
    """Add each row's chunk, and a second copy for the chunk that looks back on it.

    A row within ``look_back`` positions of its chunk's end is also needed by the
    next chunk. The copy carries ``_own = false`` and is to be filtered out after
    the window. At most ``look_back / chunk_len`` of the rows are doubled.
    """
    if chunk_len < look_back:
        raise ValueError("a chunk has to be at least as long as the look-back")
    own = F.floor(position / F.lit(chunk_len)).cast("bigint")
    reached = F.floor((position + look_back) / F.lit(chunk_len)).cast("bigint")
    return (
        df.withColumn("_home", own)
        .withColumn(chunk, F.explode(F.array_distinct(F.array(F.col("_home"), reached))))
        .withColumn("_own", F.col(chunk) == F.col("_home"))
        .drop("_home")
    )


def own_rows(df: DataFrame, chunk: str = "_chunk") -> DataFrame:
    """Drop the halo copies and the helper columns of :func:`with_halo`."""
    return df.filter("_own").drop("_own", chunk)
