"""Parsing of times, duplicate checks, and laying readings on a regular grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidegrid.grid import Grid, named

# Up to this many shifted series are matched by a broadcast table.
MAX_BROADCAST_SERIES = 100_000
# Fixed value: the label of a missing category.
MISSING_LABEL = "nan"


def parse_time(df: DataFrame, text: str, ts: str = "ts", fmt: str | None = None) -> DataFrame:
    """Turn text into timestamps; rows whose text is no time are dropped."""
    parsed = (
        F.expr(f"try_cast(`{text}` AS timestamp_ntz)")
        if fmt is None
        else F.try_to_timestamp(F.col(f"`{text}`"), F.lit(fmt)).cast("timestamp_ntz")
    )
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (text, ts)]
    return df.select(parsed.alias(ts), *rest).filter(F.col(ts).isNotNull())


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing is NULL everywhere; NaN is turned into it once, at the source."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[
            F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`")).alias(c) if c in floats else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def duplicate_timestamps(df: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Times that occur more than once in a series, with their number of rows."""
    return (
        df.groupBy(grid.series, grid.ts)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def collapse_duplicates(df: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """One row per series and time: the mean of numbers, the smallest of other types."""
    numeric = set(numeric_columns(df))
    aggregates = [
        (F.avg(named(c)) if c in numeric else F.min(named(c))).alias(c)
        for c in df.columns
        if c not in (grid.series, grid.ts)
    ]
    return df.groupBy(grid.series, grid.ts).agg(*aggregates)


def chunk_summary(
    df: DataFrame, grid: Grid = Grid(), carry: Sequence[str] = (), label: str | None = None
) -> DataFrame:
    """What cleaning needs to know beforehand, in one pass over the readings.

    One row per series, chunk and whether the readings lie ``_on`` the grid: their
    number, first and last cell, least and greatest offset, and for each column in
    ``carry`` the first and last present value with their cells (``_lo0``, ``_hi0``...).
    With ``label`` come rows without a series, one per distinct label on the grid.
    """
    cell = grid.cell()
    at = [F.when(named(c).isNotNull(), F.col("_cell")) for c in carry]
    # plain minima and maxima have buffers of fixed width, so the partial aggregate
    # hashes; of structs or sets it would sort all readings first
    ends = []
    for i, c in enumerate(carry):
        ends += [
            F.min(at[i]).alias(f"_lo_at{i}"),
            F.min_by(named(c), at[i]).alias(f"_lo_v{i}"),
            F.max(at[i]).alias(f"_hi_at{i}"),
            F.max_by(named(c), at[i]).alias(f"_hi_v{i}"),
        ]
    facts = [
        F.count(F.lit(1)).alias("n"),
        F.min("_cell").alias("lo"),
        F.max("_cell").alias("hi"),
        F.min("_offset").alias("least"),
        F.max("_offset").alias("most"),
        *ends,
    ]
    timed = df.filter(F.col(grid.ts).isNotNull() & F.col(grid.series).isNotNull()).select(
        F.col(grid.series),
        grid.chunk(cell).alias("_chunk"),
        grid.on_grid().alias("_on"),
        cell.alias("_cell"),
        grid.offset().alias("_offset"),
        *[named(c) for c in carry],
        *([F.when(grid.on_grid(), label_of(label)).alias("_label")] if label else []),
    )
    place = [grid.series, "_chunk", "_on"]
    if not label:
        return timed.groupBy(*place).agg(*facts)
    return timed.groupingSets([place, ["_label"]], *place, "_label").agg(*facts)


def label_of(column: str) -> Column:
    """The label of a category; a missing one is a label too."""
    return F.coalesce(named(column).cast("string"), F.lit(MISSING_LABEL))


def series_extent(df: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Per series: first and last cell, rows on the grid, and whether it is ``shifted``.

    A shifted series is complete, but lies off the grid by a constant offset.
    """
    return extent_of(chunk_summary(df, grid), grid)


def extent_of(summary: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """:func:`series_extent` of an already computed :func:`chunk_summary`."""
    shifted = "least = most AND least > INTERVAL '0' SECOND AND n = hi - lo + 1 AND n > 2"
    return (
        summary.groupBy(grid.series)
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("_on"), F.col("n")).otherwise(0)).alias("on_grid"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.min("least").alias("least"),
            F.max("most").alias("most"),
        )
        .select(grid.series, "lo", "hi", "on_grid", F.expr(shifted).alias("shifted"))
    )


def snap_regular_offset(
    df: DataFrame, grid: Grid = Grid(), extents: DataFrame | None = None, known: int | None = None
) -> DataFrame:
    """Move shifted series onto the grid; every other series is left alone.

    Shifted series are usually none, so they are counted first (or their number
    is given): without any the frame comes back as it is.
    """
    if extents is None:
        extents = series_extent(df, grid)
    shifted = extents.filter("shifted").select(grid.series, "shifted")
    if known is None:
        known = shifted.limit(MAX_BROADCAST_SERIES + 1).count()
    if known == 0:
        return df
    right = F.broadcast(shifted) if known <= MAX_BROADCAST_SERIES else shifted
    moved = F.when(F.col("shifted"), grid.floor()).otherwise(
        F.col(grid.ts).cast("timestamp_ntz")
    )
    return df.join(right, grid.series, "left").withColumn(grid.ts, moved).select(*map(named, df.columns))


def regrid(df: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Reindex every series to its full grid: holes are NULL, off-grid rows are dropped."""
    values = [c for c in df.columns if c not in (grid.series, grid.ts)]
    cells = grid_cells(df, grid, carry=())
    return cells.select(grid.series, grid.time_of("_cell").alias(grid.ts), *values)


def grid_cells(
    df: DataFrame, grid: Grid, carry: Sequence[str], summary: DataFrame | None = None
) -> DataFrame:
    """The grid as ``(series, _cell, values...)``; the values of holes are NULL.

    Readings and one row per chunk, which begins it, meet in one shuffle and are sorted;
    only then is each row spread over the empty cells up to the next one. No array longer
    than a chunk is ever built, the spine is never joined, and no cell is sorted.

    For the columns in ``carry`` come ``_prev0``, ``_next0``... with cell and value (``at``,
    ``v``) of the last present value up to a cell and of the first one after it. The ones
    next to a chunk come along as rows of their own outside the chunk's range (at most two
    per column and chunk). ``summary`` is the :func:`chunk_summary` of the same readings
    and columns.
    """
    series = grid.series
    values = [c for c in df.columns if c not in (series, grid.ts)]
    types = {f.name: f.dataType for f in df.schema.fields}
    cell = grid.cell()

    timed = df.filter(F.col(grid.ts).isNotNull() & F.col(series).isNotNull())
    readings = timed.filter(grid.on_grid()).select(
        F.col(series),
        grid.chunk(cell).alias("_chunk"),
        cell.alias("_first"),
        F.lit(None).cast("bigint").alias("_last"),
        F.lit(1).alias("_reading"),
        *map(named, values),
    )
    if summary is None:
        summary = chunk_summary(timed, grid, carry)
    marks = _chunk_rows(summary, grid, values, types, carry)

    # a row grows into many cells on arrival, which Spark cannot foresee when it
    # merges small partitions, hence the explicit number
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = readings.unionByName(marks).repartition(partitions, series, "_chunk")
    # of rows at the same cell the one that begins the chunk is first
    ordered = Window.partitionBy(series, "_chunk").orderBy("_first", "_reading")
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    seen = []
    for i, c in enumerate(carry):
        here = F.when(named(c).isNotNull(), F.struct(F.col("_first").alias("at"), named(c).alias("v")))
        rows = rows.withColumn(f"_here{i}", here)
        seen += [
            F.last(f"_here{i}", True).over(upto).alias(f"_prev{i}"),
            F.expr(f"lead(_here{i}) IGNORE NULLS").over(ordered).alias(f"_next{i}"),
        ]
    # the chunk's last cell is known from the row that begins it
    following, end = F.lead("_first").over(ordered), F.max("_last").over(upto)
    spans = rows.select("*", *seen, following.alias("_following"), F.least(following - 1, end).alias("_until"))
    clash = F.raise_error(
        F.concat(F.lit("duplicate timestamps in series "), F.col(series).cast("string"))
    ).cast("boolean")
    twice = (F.col("_reading") == 1) & (F.col("_following") == F.col("_first"))
    # the neighbours' rows have done their work
    own = (grid.chunk(F.col("_first")) == F.col("_chunk")) & (F.col("_first") <= F.col("_until"))
    cells = spans.filter(F.when(twice, clash).otherwise(own)).withColumn("_cell", F.explode(F.sequence("_first", "_until")))
    return cells.select(
        series,
        "_cell",
        *[F.when(F.col("_cell") == F.col("_first"), named(c)).alias(c) for c in values],
        *[f"_{side}{i}" for i in range(len(carry)) for side in ("prev", "next")],
    )


def _chunk_rows(
    summary: DataFrame,
    grid: Grid,
    values: list[str],
    types: dict[str, T.DataType],
    carry: Sequence[str],
) -> DataFrame:
    """One row per chunk of the grid, from its ``_first`` cell to its ``_last``, and rows
    without a ``_last`` for the nearest values outside it.

    Everything here rests on the summary of the readings by series and chunk: a
    century of hours is a few hundred rows.
    """
    series = grid.series
    shaped = []
    for i in range(len(carry)):
        for side in ("lo", "hi"):
            here = F.struct(F.col(f"_{side}_at{i}").alias("at"), F.col(f"_{side}_v{i}").alias("v"))
            present = F.col("_on") & F.col(f"_{side}_at{i}").isNotNull()
            shaped.append(F.max(F.when(present, here)).alias(f"_{side}{i}"))
    # readings off the grid count for a series' extent, not for its values
    summary = summary.groupBy(series, "_chunk").agg(F.min("lo").alias("_lo"), F.max("hi").alias("_hi"), *shaped)
    whole = Window.partitionBy(series)
    ordered = whole.orderBy("_chunk")
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    after = whole.orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    known = summary.select(
        series,
        "_chunk",
        F.lead("_chunk").over(ordered).alias("_next"),
        F.min("_lo").over(whole).alias("_lo"),
        F.max("_hi").over(whole).alias("_hi"),
        *[F.last(f"_hi{i}", True).over(before).alias(f"_before{i}") for i in range(len(carry))],
        *[F.last(f"_hi{i}", True).over(upto).alias(f"_upto{i}") for i in range(len(carry))],
        *[F.last(f"_lo{i}", True).over(after).alias(f"_after{i}") for i in range(len(carry))],
    )
    # chunks without any reading follow the one before them
    spread = known.withColumnRenamed("_chunk", "_known").withColumn(
        "_chunk", F.explode(F.sequence("_known", F.coalesce(F.col("_next") - 1, F.col("_known"))))
    )

    def entry(first: Column, last: Column, filled: dict[str, Column]) -> Column:
        return F.struct(
            first.alias("_first"),
            last.alias("_last"),
            F.lit(0).alias("_reading"),
            *[filled.get(c, F.lit(None)).cast(types[c]).alias(c) for c in values],
        )

    start = F.col("_chunk") * grid.chunk_cells
    first, last = F.greatest("_lo", start), F.least("_hi", start + (grid.chunk_cells - 1))
    entries = [entry(first, last, {})]
    own = F.col("_chunk") == F.col("_known")
    for i, c in enumerate(carry):
        earlier = F.when(own, F.col(f"_before{i}")).otherwise(F.col(f"_upto{i}"))
        for side in (earlier, F.col(f"_after{i}")):
            entries.append(entry(side["at"], F.lit(None).cast("bigint"), {c: side["v"]}))
    return (
        spread.select(series, "_chunk", F.explode(F.array(*entries)).alias("e"))
        .select(series, "_chunk", "e.*")
        .filter(F.col("_first").isNotNull())
    )
