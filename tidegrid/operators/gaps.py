"""Filling of missing cells: bounded interpolation, then seasonal medians."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.grid import Grid, named
from tidegrid.operators.regrid import grid_cells
from tidegrid.session import settings, settle, shuffles_removed

DEFAULT_LIMIT = 24
# Seasons of a long series hold many cells; their joins are dealt out by this many salts.
SEASON_SALTS = 8
# Up to this many seasons with a hole are matched by a broadcast table.
MAX_BROADCAST_SEASONS = 100_000
# The values of a season are brought together up to so many; those of a larger one are counted.
MAX_GATHERED = 10_000


def interpolate(
    df: DataFrame,
    columns: Sequence[str],
    grid: Grid = Grid(),
    limit: int = DEFAULT_LIMIT,
    summary: DataFrame | None = None,
) -> DataFrame:
    """Lay readings on the grid and fill short gaps along the line between neighbours.

    The first ``limit`` cells of a gap are filled; a gap at the end repeats the
    last value up to ``limit``; cells before the first value stay empty. Rows that
    already lie on the grid are fine as input: missing cells are simply added.
    ``summary`` is a :func:`chunk_summary` of the readings that carries the same columns.
    """
    values = [c for c in df.columns if c not in (grid.series, grid.ts)]
    typed = df.select(
        grid.series,
        grid.ts,
        *[named(c).cast("double").alias(c) if c in columns else named(c) for c in values],
    )
    cells = grid_cells(typed, grid, list(columns), summary)
    filled = {c: _on_line(named(c), i, limit) for i, c in enumerate(columns)}
    return cells.select(
        grid.series,
        grid.time_of("_cell").alias(grid.ts),
        *[filled.get(c, named(c)).alias(c) for c in values],
    )


def _on_line(value: Column, i: int, limit: int) -> Column:
    prev, following = F.col(f"_prev{i}"), F.col(f"_next{i}")
    steps = F.col("_cell") - prev["at"]
    slope = (following["v"] - prev["v"]) / (following["at"] - prev["at"])
    return (
        F.when(value.isNotNull(), value)
        .when(prev.isNull() | (steps > limit), F.lit(None))
        .when(following.isNull(), prev["v"])
        .otherwise(prev["v"] + slope * steps)
    )


def fill_seasonal(
    df: DataFrame,
    columns: Sequence[str],
    grid: Grid = Grid(),
    same_day: bool = True,
    same_month_hour: bool = True,
    stored: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Fill what is still missing with medians of the same season in the same series.

    First the median over the same month, day and hour of other years, then, if
    there is none, over the same month and hour of any day and year. Both pools
    hold the cells present on entry, so the outcome does not depend on the order
    of visits. On a grid a missing cell is never in its own pool.

    Values alone are brought together, one list per season, where a season has at most
    MAX_GATHERED of them. Those of larger seasons that have a hole are counted first, and
    medians are picked from the counts (see :func:`counted_medians`). Days of other years
    are looked at in seasons that have a day both with a hole and with a value; a series of
    less than a year has none. Only cells with a hole meet their medians again. The table is
    settled, since it is read for the holes, the medians and the result.

    ``stored`` holds :func:`value_counts` of cells seen before, and per series the last
    cell they cover of each column (``_to0``...); cells up to there are not counted again.
    """
    season = [grid.series, "_month", "_hour"]
    hole = reduce(or_, [named(c).isNull() for c in columns], F.lit(False))
    tiers = [(k, name) for wanted, k, name in ((same_day, [*season, "_day"], "_fine"), (same_month_hour, season, "_coarse")) if wanted]
    # what a step has shuffled goes when it is settled
    with shuffles_removed(df.sparkSession):
        table = settle(df.select(*[named(c).cast("double").alias(c) if c in columns else named(c) for c in df.columns]))
        needs = settle(_season_needs(table, columns, grid).filter(reduce(or_, [F.col(f"_hole{i}") for i in range(len(columns))], F.lit(False))))
        if not tiers or needs.isEmpty():
            return table
        large = F.lit(True) if stored else F.greatest(F.lit(0), *[F.col(f"_n{i}") for i in range(len(columns))]) > MAX_GATHERED
        counted, gathered = needs.filter(large), needs.filter(~large)
        counts = None if counted.isEmpty() else _needed_counts(table, columns, grid, counted, stored)
        found = []
        for keys, name in tiers:
            medians = [] if counts is None else [_wide(counted_medians(counts, [*keys, "_column"]), keys, columns, name)]
            if not stored:
                medians += _gathered_medians(table, columns, grid, gathered, counted if counts is not None else None, keys, name)
            if medians:
                # hashed lists of over 128 seasons are given up for a sort of each row with a second
                # copy of its key, so rows are sorted from the start
                with settings(df.sparkSession, spark__sql__execution__useObjectHashAggregateExec="false"):
                    found.append((keys, name, settle(reduce(DataFrame.unionByName, medians))))
    filled = _with_season(table.filter(hole), grid)
    for keys, name, medians in found:
        filled = _join_salted(filled, medians, keys, "left", grid)
    position = {c: i for i, c in enumerate(columns)}

    def value(c: str) -> Column:
        if c not in position:
            return named(c)
        return F.coalesce(named(c), *[F.col(f"{name}{position[c]}") for _, name, _ in found]).alias(c)

    return table.filter(~hole).unionByName(filled.select(*[value(c) for c in df.columns]))


def _season_needs(table: DataFrame, columns: Sequence[str], grid: Grid) -> DataFrame:
    """Per season and column: is there a hole (``_hole0``...), how many values there are
    (``_n0``...) and, as bits, the days that have a hole in one year and a value in another
    (``_twice0``...)."""
    bit, facts, twice = F.expr("shiftleft(1, _day)"), [], []
    for i, c in enumerate(columns):
        absent = named(c).isNull()
        facts += [
            F.max(absent).alias(f"_hole{i}"),
            F.count(named(c)).alias(f"_n{i}"),
            F.bit_or(F.when(absent, bit)).alias(f"_without{i}"),
            F.bit_or(F.when(~absent, bit)).alias(f"_with{i}"),
        ]
        both = F.col(f"_without{i}").bitwiseAND(F.col(f"_with{i}"))
        twice += [f"_hole{i}", f"_n{i}", F.coalesce(both, F.lit(0)).alias(f"_twice{i}")]
    season = [grid.series, "_month", "_hour"]
    facts = facts or [F.lit(False).alias("_none")]
    return _with_season(table, grid).groupBy(*season).agg(*facts).select(*season, *twice)


def _needed_counts(
    table: DataFrame, columns: Sequence[str], grid: Grid, needs: DataFrame, stored: tuple[DataFrame, DataFrame] | None
) -> DataFrame:
    """Settled :func:`value_counts` of the seasons and columns that have a hole."""
    counts = value_counts(table, columns, grid, needs, stored[1] if stored else None)
    if stored:
        earlier = _at_season(stored[0], needs, [grid.series, "_month", "_hour"], grid, "_value")
        flag = reduce(or_, [(F.col("_column") == i) & F.col(f"_hole{i}") for i in range(len(columns))])
        counts = counts.unionByName(earlier.filter(flag).select(counts.columns))
    return settle(counts)


def _wide(medians: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str) -> DataFrame:
    return medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_column") == i, F.col("median"))).alias(f"{name}{i}") for i in range(len(columns))]
    )


def _gathered_medians(
    table: DataFrame, columns: Sequence[str], grid: Grid, needs: DataFrame, large: DataFrame | None, keys: Sequence[str], name: str
) -> list[DataFrame]:
    """Medians of the seasons in ``needs`` from lists of their values; no frame if none has any."""
    season, n = [grid.series, "_month", "_hour"], range(len(columns))
    cells = _with_season(table, grid)
    if "_day" in keys:
        needs = needs.filter(reduce(or_, [F.col(f"_twice{i}") != 0 for i in n]))
        if needs.isEmpty():
            return []
        wanted = [F.expr(f"(_twice{i} & shiftleft(1, _day)) != 0") for i in n]
        pool = _at_season(cells, needs, season, grid).filter(reduce(or_, wanted))
    elif needs.limit(MAX_BROADCAST_SEASONS + 1).count() <= MAX_BROADCAST_SEASONS:
        wanted = [F.col(f"_hole{i}") for i in n]
        pool = cells.join(F.broadcast(needs), season)
    else:
        # nearly all seasons have a hole: their cells need not meet the list of them
        wanted = [F.lit(True)] * len(columns)
        pool = cells if large is None else cells.join(large, season, "left_anti")
    values = [F.when(w, named(c)).alias(f"_v{i}") for i, (w, c) in enumerate(zip(wanted, columns))]
    pool = pool.select(*keys, *values).filter(reduce(or_, [F.col(f"_v{i}").isNotNull() for i in n]))
    lists = pool.groupBy(*keys).agg(*[F.sort_array(F.collect_list(f"_v{i}")).alias(f"_v{i}") for i in n])
    return [lists.select(*keys, *[_middle(f"_v{i}").alias(f"{name}{i}") for i in n])]


def _middle(values: str) -> Column:
    """The median of a sorted list; NULL if it is empty."""
    low, high = f"{values}[(size({values}) - 1) div 2]", f"{values}[size({values}) div 2]"
    return F.expr(f"CASE WHEN size({values}) > 0 THEN 0.5D * {low} + 0.5D * {high} END")


def _with_season(df: DataFrame, grid: Grid) -> DataFrame:
    ts = F.col(grid.ts)
    season = (F.month(ts).alias("_month"), F.hour(ts).alias("_hour"), F.dayofmonth(ts).alias("_day"))
    return df.select("*", *season)


def _join_salted(
    cells: DataFrame, table: DataFrame, keys: Sequence[str], how: str, grid: Grid, spread: str | None = None
) -> DataFrame:
    """Join cells with a table of one row per season, whose rows are copied to each salt."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SEASON_SALTS - 1)))
    salt = F.pmod(F.xxhash64(spread or grid.ts), F.lit(SEASON_SALTS)).cast("int")
    on = [*keys, "_salt"]
    return cells.withColumn("_salt", salt).join(table.withColumn("_salt", salts), on, how).drop("_salt")


def _at_season(rows: DataFrame, needs: DataFrame, season: Sequence[str], grid: Grid, spread: str | None = None) -> DataFrame:
    """The rows of the seasons that have a hole, with the columns that have it."""
    if needs.limit(MAX_BROADCAST_SEASONS + 1).count() <= MAX_BROADCAST_SEASONS:
        return rows.join(F.broadcast(needs), list(season))
    return _join_salted(rows, needs, season, "inner", grid, spread)


def value_counts(
    table: DataFrame,
    columns: Sequence[str],
    grid: Grid,
    needs: DataFrame | None = None,
    after: DataFrame | None = None,
    until: DataFrame | None = None,
) -> DataFrame:
    """``(series, _month, _hour, _day, _column, _value, _n)``: how often a value occurs.

    With ``needs`` only in seasons and columns that have a hole. ``after`` and ``until``
    bound the cells of each series and column: cells up to ``_to<i>`` are left out, and
    cells beyond ``_hi<i>`` (a series or column that ``after`` lacks is counted whole).
    """
    season = [grid.series, "_month", "_hour"]
    pool = _with_season(table, grid).withColumn("_at", grid.cell())
    for bounds in (after, until):
        if bounds is not None:
            pool = pool.join(bounds, grid.series, "left" if bounds is after else "inner")
    values = []
    for i, c in enumerate(columns):
        counted = F.lit(True)
        if after is not None:
            counted = counted & (F.col(f"_to{i}").isNull() | (F.col("_at") > F.col(f"_to{i}")))
        if until is not None:
            counted = counted & (F.col("_at") <= F.col(f"_hi{i}"))
        values.append(F.when(counted, named(c).cast("double")).alias(f"_v{i}"))
    pool = pool.select(*season, "_day", grid.ts, *values)
    if needs is not None:
        pool = _at_season(pool, needs, season, grid)
    wanted = [F.col(f"_hole{i}") if needs is not None else F.lit(True) for i in range(len(columns))]
    entries = F.array(
        *[F.struct(F.lit(i).alias("_column"), F.when(w, F.col(f"_v{i}")).alias("_value")) for i, w in enumerate(wanted)]
    )
    melted = pool.select(*season, "_day", F.explode(entries).alias("e")).select(*season, "_day", "e.*")
    return melted.filter(F.col("_value").isNotNull()).groupBy(*season, "_day", "_column", "_value").agg(F.count(F.lit(1)).alias("_n"))


def counted_medians(counts: DataFrame, keys: Sequence[str], value: str = "_value", n: str = "_n") -> DataFrame:
    """The median of each group, from a table of its values with their numbers.

    Values are sorted by group and value in ranges, which cut a long group wherever it is
    long. Subtotals tell in which ranges a group's two middle ranks lie, and running
    counts within those ranges which values have them. No task holds a whole group.
    """
    keys = list(keys)
    values = counts.groupBy(*keys, value).agg(F.sum(n).alias(n))
    order = [*keys, value]
    ranged = settle(
        values.repartitionByRange(*order).select(*order, n, F.spark_partition_id().alias("_part"))
    )
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy(*keys, "_part").agg(F.sum(n).alias("_rows"))
    placed = parts.select(
        *keys,
        "_part",
        "_rows",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias("_all"),
    )
    # the two middle ranks are one where the number is odd
    placed = placed.select("*", F.expr("(_all + 1) div 2").alias("_low"), F.expr("_all div 2 + 1").alias("_high"))
    middle = placed.filter((F.col("_before") < F.col("_high")) & (F.col("_before") + F.col("_rows") >= F.col("_low")))
    running = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = ranged.join(middle.drop("_rows", "_all"), [*keys, "_part"]).withColumn(
        "_upto", F.col("_before") + F.sum(n).over(running)
    )

    def at(rank: str) -> Column:
        here = (F.col("_upto") >= F.col(rank)) & (F.col("_upto") - F.col(n) < F.col(rank))
        return F.min(F.when(here, F.col(value)))

    return ranked.groupBy(*keys).agg(((at("_low") + at("_high")) / 2).alias("median"))
