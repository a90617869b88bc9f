"""Calendar, lag, rolling and tier features of the target."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.grid import Grid, named, own_rows, with_halo

# Rows looked back on, and upper ends of the air-quality tiers.
LAGS = (1, 3, 6, 12, 24)
MEAN_WINDOWS = (3, 6, 12, 24)
STD_WINDOWS = (6, 12, 24)
TIER_LIMITS = (12.0, 35.4, 55.4, 150.4, 250.4)
NIGHT_ENDS, NIGHT_STARTS = 6, 20

# Longest window whose cells are fetched one by one.
MAX_LAGGED_WINDOW = 48


def calendar_columns(ts: Column) -> list[Column]:
    """hour, day, month, day_of_week (Monday is 0), is_weekend, is_night."""
    hour, weekday = F.hour(ts), F.weekday(ts)
    return [
        hour.alias("hour"),
        F.dayofmonth(ts).alias("day"),
        F.month(ts).alias("month"),
        weekday.alias("day_of_week"),
        (weekday >= 5).cast("int").alias("is_weekend"),
        ((hour < NIGHT_ENDS) | (hour >= NIGHT_STARTS)).cast("int").alias("is_night"),
    ]


def cyclical_columns(ts: Column) -> list[Column]:
    angle = F.hour(ts) * (2 * math.pi) / 24
    return [F.sin(angle).alias("sin_hour"), F.cos(angle).alias("cos_hour")]


def aqi_tier(value: Column) -> Column:
    """Air-quality tier 0 to 5; a missing value falls through to 5."""
    tier = F.when(value <= TIER_LIMITS[0], 0)
    for level, limit in enumerate(TIER_LIMITS[1:], start=1):
        tier = tier.when(value <= limit, level)
    return tier.otherwise(len(TIER_LIMITS))


def history_features(
    df: DataFrame,
    grid: Grid = Grid(),
    target: str = "target",
    lags: Sequence[int] = LAGS,
    mean_windows: Sequence[int] = MEAN_WINDOWS,
    std_windows: Sequence[int] = STD_WINDOWS,
    shift: int = 0,
) -> DataFrame:
    """Lags and rolling mean and standard deviation over a gap-free grid.

    A rolling value is NULL until its window is full and while a cell in it is
    missing. With ``shift=0`` the window ends at the row itself; ``shift=1`` keeps
    the row's own target out of its features.

    Everything is read off one set of lags: one shuffle, one sort, constant work
    per lag and row. Sums of lags are NULL wherever a cell is missing, which is
    just the rule above. A sliding frame would redo its whole window for each row:
    windows too long for lags are put together from two running aggregates instead
    (see :func:`_long_windows`), again with constant work per row.
    """
    windows = sorted({*mean_windows, *std_windows})
    look_back = max([0, *lags, *[w - 1 + shift for w in windows]])
    order = Window.partitionBy(grid.series, "_chunk").orderBy(grid.ts)
    short = [w for w in windows if w <= MAX_LAGGED_WINDOW]
    reach = max([0, *[w - 1 + shift for w in short]])
    offsets = sorted({*lags, *range(1, reach + 1)})
    value = named(target)

    seen = [F.lag(value, k).over(order).alias(f"_lag{k}") for k in offsets]
    haloed = with_halo(df, grid.cell(), max(grid.chunk_cells, look_back), look_back)
    rows = haloed.select("*", *seen)
    for w in windows:
        if w not in short:
            rows = _long_windows(rows, value, grid, w, shift)
    rows = own_rows(rows)

    def at(k: int) -> str:
        return f"`_lag{k}`" if k else f"`{target}`"

    def total(terms: list[str]) -> str:
        return "(" + " + ".join(terms) + ")"

    means, features = [], [F.col(f"_lag{k}").alias(f"lag_{k}h") for k in lags]
    for w in windows:
        cells = [at(k + shift) for k in range(w)]
        if w in short:
            means.append(F.expr(f"{total(cells)} / {w}D").alias(f"_mean{w}"))
        if w in mean_windows:
            features.append(F.col(f"_mean{w}").alias(f"rolling_mean_{w}h"))
        if w in std_windows and w in short:
            squares = total([f"({c} - _mean{w}) * ({c} - _mean{w})" for c in cells])
            deviation = f"CASE WHEN {w} > 1 THEN sqrt({squares} / {max(w - 1, 1)}D) END"
            features.append(F.expr(deviation).alias(f"rolling_std_{w}h"))
        elif w in std_windows:
            features.append(F.col(f"_std{w}").alias(f"rolling_std_{w}h"))
    kept = [F.col(f"`{c}`") for c in df.columns]
    return rows.select("*", *means).select(*kept, *features)


def _long_windows(rows: DataFrame, value: Column, grid: Grid, w: int, shift: int) -> DataFrame:
    """Add ``_mean<w>`` and ``_std<w>`` of the w cells that end ``shift`` rows back.

    Cells are cut into blocks of w. A window covers the end of one block and the beginning
    of the next, so it is a suffix of the one merged with a prefix of the other: both
    are running aggregates (number, mean, sum of squares about the mean). The suffix is
    fetched w - 1 rows back, the whole shifted by a lag. Rows are those of a chunk with its
    halo, one per grid cell.
    """
    block = F.floor(grid.cell() / F.lit(w))
    running = Window.partitionBy(grid.series, "_chunk", "_block").rowsBetween(Window.unboundedPreceding, 0)
    order = Window.partitionBy(grid.series, "_chunk").orderBy(grid.ts)
    x = value.cast("double")

    def stats(window) -> Column:
        return F.struct(
            F.count(x).over(window).alias("n"),
            F.avg(x).over(window).alias("mean"),
            (F.var_pop(x).over(window) * F.count(x).over(window)).alias("m2"),
        )

    parts = rows.withColumn("_block", block).select(
        "*",
        stats(running.orderBy(grid.ts)).alias("_prefix"),
        stats(running.orderBy(F.desc(grid.ts))).alias("_suffix"),
    )
    # before the suffix the window reaches into the block before, unless it is the block
    earlier = F.lag("_suffix", w - 1).over(order)
    same = F.lag("_block", w - 1).over(order) == F.col("_block")
    parts = parts.withColumn("_earlier", F.when(~same, earlier)).withColumn("_whole", same)
    p, e = F.col("_prefix"), F.col("_earlier")
    n = p["n"] + F.coalesce(e["n"], F.lit(0))
    gap = p["mean"] - e["mean"]
    mean = F.when(F.col("_whole"), p["mean"]).otherwise(e["mean"] + gap * p["n"] / n)
    m2 = F.when(F.col("_whole"), p["m2"]).otherwise(p["m2"] + e["m2"] + gap * gap * e["n"] * p["n"] / n)
    full = F.col("_whole").isNotNull() & (n == w)
    found = parts.select(
        *[named(c) for c in rows.columns],
        F.when(full, mean).alias(f"_mean{w}"),
        F.when(full & (F.lit(w) > 1), F.sqrt(m2 / (w - 1))).alias(f"_std{w}"),
    )
    if not shift:
        return found
    return found.withColumns({c: F.lag(c, shift).over(order) for c in (f"_mean{w}", f"_std{w}")})


def feature_table(
    df: DataFrame,
    grid: Grid = Grid(),
    target: str = "target",
    shift: int = 0,
    complete_only: bool = True,
) -> DataFrame:
    """All features of a cleaned, gap-free table; incomplete rows are dropped.

    A row is complete when its own columns, its lags and its widest mean are there:
    narrower windows lie inside the widest, and the standard deviation is missing
    only where the mean is. Testing those few keeps the filter cheap.
    """
    ts = F.col(grid.ts)
    history = history_features(df, grid, target, shift=shift)
    if complete_only:
        needed = [f"lag_{k}h" for k in LAGS] + [f"rolling_mean_{max(MEAN_WINDOWS)}h"]
        history = history.filter(reduce(and_, [named(c).isNotNull() for c in [*df.columns, *needed]]))
    return history.select(
        "*",
        *calendar_columns(ts),
        *cyclical_columns(ts),
        aqi_tier(named(target)).alias("pm2_5_tier"),
    )
