"""New readings in batches: what a batch leaves to the next one is kept in small tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.grid import Grid, named
from tidegrid.operators.encoding import encode, weather_column
from tidegrid.operators.features import LAGS, MEAN_WINDOWS, feature_table
from tidegrid.operators.gaps import DEFAULT_LIMIT, fill_seasonal, interpolate, value_counts
from tidegrid.operators.naming import drop_columns
from tidegrid.operators.regrid import nan_to_null, numeric_columns
from tidegrid.plans.dataset import Fitted, scaled_features
from tidegrid.session import settle
from tidegrid.sources.files import file_exists, list_folders

# Rows a feature looks back on, its own included.
LOOK_BACK = max(*LAGS, *[w - 1 for w in MEAN_WINDOWS]) + 1


@dataclass
class SeriesState:
    """What is known of each series after a batch.

    ``tail``: its last readings, as many cells as features and gaps look back on.
    ``pools``: counts of the values of all cells that cannot change any more.
    ``marks``: per series the last cell given out (``_done``) and, per column, the last
    cell counted (``_to0``...).
    """

    tail: DataFrame
    pools: DataFrame
    marks: DataFrame

    def save(self, path: str) -> None:
        """Write the next generation; it counts once its marker is there, which comes last."""
        spark = self.tail.sparkSession
        number = (max(_generations(spark, path), default=0)) + 1
        for name in ("tail", "pools", "marks"):
            getattr(self, name).write.parquet(f"{path}/{number}/{name}")
        spark.range(1).write.parquet(f"{path}/{number}/complete")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SeriesState | None:
        """The last complete generation, or none."""
        for number in sorted(_generations(spark, path), reverse=True):
            if file_exists(spark, f"{path}/{number}/complete/_SUCCESS"):
                return cls(*[spark.read.parquet(f"{path}/{number}/{n}") for n in ("tail", "pools", "marks")])
        return None


def _generations(spark: SparkSession, path: str) -> list[int]:
    return [int(n) for n in list_folders(spark, path) if n.isdigit()]


def transform_batch(
    batch: DataFrame,
    fitted: Fitted,
    state: SeriesState | None = None,
    grid: Grid = Grid(),
    limit: int = DEFAULT_LIMIT,
    flush: bool = False,
) -> tuple[DataFrame, SeriesState]:
    """Process a batch of new readings as if all earlier ones had been read with it.

    A row is given out once no later reading can change its own values: when every
    measured column has a value at or after it (``flush`` gives out the rest too). Its
    gaps, lags and rolling values then are those of one run over all readings so far;
    medians draw on the cells of all batches. Readings must be later than those of the
    same series in earlier batches; series are not moved onto the grid. The work is that
    of the batch and the tails. Both results are computed.
    """
    readings = nan_to_null(drop_columns(batch))
    weather = weather_column(readings.columns)
    numeric = [c for c in numeric_columns(readings, exclude=(grid.series, grid.ts, weather))]
    kept = [named(c).cast("double").alias(c) if c in numeric else named(c) for c in readings.columns]
    readings = readings.select(*kept)
    if state is not None:
        readings = state.tail.select(*map(named, readings.columns)).unionByName(readings)
    readings = settle(readings.filter(F.col(grid.ts).isNotNull()).withColumn("_at", grid.cell()))
    marks = state.marks if state is not None else None

    present = [F.max(F.when(named(c).isNotNull() & grid.on_grid(), F.col("_at"))).alias(f"_hi{i}") for i, c in enumerate(numeric)]
    # a column never seen stays empty up to here, whatever comes
    ends = readings.groupBy(grid.series).agg(F.max("_at").alias("_last"), *present)
    ends = settle(ends.withColumn("_final", F.least("_last", *[F.coalesce(f"_hi{i}", "_last") for i in range(len(numeric))])))

    filled = interpolate(readings.drop("_at"), numeric, grid, limit)
    if weather:
        filled = encode(filled, weather, fitted.encoding)
    filled = settle(filled)
    stored = (state.pools, marks.drop("_done")) if state is not None else None
    cleaned = fill_seasonal(filled, numeric, grid, stored=stored)
    table = feature_table(cleaned, grid, fitted.target).withColumn("_at", grid.cell())
    done = marks.select(grid.series, "_done") if marks is not None else None
    table = table.join(ends.select(grid.series, "_final"), grid.series)
    table = table.join(done, grid.series, "left") if done is not None else table.withColumn("_done", F.lit(None).cast("long"))
    new = F.col("_done").isNull() | (F.col("_at") > F.col("_done"))
    table = table.filter(new if flush else new & (F.col("_at") <= F.col("_final"))).drop("_at", "_final", "_done")
    rows = settle(scaled_features(table, fitted, grid))

    # what is final is counted and done with; the tail reaches back from there
    until = ends.select(grid.series, *[f"_hi{i}" for i in range(len(numeric))])
    added = value_counts(filled, numeric, grid, after=marks.drop("_done") if marks is not None else None, until=until)
    if state is not None:
        keys = [c for c in added.columns if c != "_n"]
        added = state.pools.unionByName(added).groupBy(*keys).agg(F.sum("_n").alias("_n"))
    last = F.col("_last") if flush else F.col("_final")
    first = (last - (LOOK_BACK + limit) + 1).alias("_first")
    tail = readings.join(ends.select(grid.series, first), grid.series).filter(F.col("_at") >= F.col("_first"))
    tail = _from_first(tail, readings, ends.select(grid.series, first), grid)
    new_marks = ends.select(grid.series, last.alias("_done"), *[F.col(f"_hi{i}").alias(f"_to{i}") for i in range(len(numeric))])
    return rows, SeriesState(settle(tail), settle(added), settle(new_marks))


def _from_first(tail: DataFrame, readings: DataFrame, firsts: DataFrame, grid: Grid) -> DataFrame:
    """Series that began earlier get an empty reading at the tail's first cell, if there is
    none on the grid, so that the grid begins there."""
    columns = [c for c in tail.columns if c not in ("_at", "_first")]
    facts = readings.join(firsts, grid.series).groupBy(grid.series, "_first").agg(
        F.min("_at").alias("_least"),
        F.count_if((F.col("_at") == F.col("_first")) & grid.on_grid()).alias("_there"),
    )
    empty = facts.filter((F.col("_least") < F.col("_first")) & (F.col("_there") == 0))
    kinds = {f.name: f.dataType for f in tail.schema.fields}
    filled = {grid.series: F.col(grid.series), grid.ts: grid.time_of("_first")}
    made = empty.select(*[filled.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in columns])
    return tail.select(*map(named, columns)).unionByName(made)


def transform_batches(batches: list[DataFrame], fitted: Fitted, grid: Grid = Grid(), limit: int = DEFAULT_LIMIT) -> DataFrame:
    """The rows of successive batches, the last one flushed."""
    state, parts = None, []
    for number, batch in enumerate(batches, 1):
        rows, state = transform_batch(batch, fitted, state, grid, limit, flush=number == len(batches))
        parts.append(rows)
    return reduce(DataFrame.unionByName, parts)
