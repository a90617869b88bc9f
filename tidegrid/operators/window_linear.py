"""Linear models on windows of rows, fitted without making the windows.

The normal equations of a window model hold sums of products of rows that lie d apart, for
all d up to the window's length. Such a sum over all places of a window in a series is the
sum over the whole series less a few products at its two ends. So the rows are read once,
chunk by chunk with a halo, for the lagged products of the whole series, and the first and
last rows of each series for the ends; a window of L rows of F features is never built, and
a task holds the sums (L F by L F numbers) and one chunk.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.grid import Grid, named, with_halo
from tidegrid.operators.sequences import DEFAULT_LENGTH
from tidegrid.session import settle

SUMS = pa.schema([("part", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("value", pa.float64())])
SUMS_SQL = "part string, a int, b int, i int, j int, value double"


@dataclass(frozen=True)
class WindowLinear:
    """A row of weights for each row of the window, the oldest first."""

    features: list[str]
    weights: list[list[float]]
    intercept: float
    rows: int


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Rows of one key after the other, as matrices without the key."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        cells = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[1:]])
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for first, end in zip(cuts, cuts[1:]):
            if keys[first] != key and held:
                yield np.concatenate(held)
                held = []
            key = keys[first]
            held.append(cells[first:end])
    if held:
        yield np.concatenate(held)


def _listed(part: str, sums: np.ndarray) -> pa.RecordBatch:
    """The sums as rows; missing dimensions come first."""
    full = sums.reshape((1,) * (4 - sums.ndim) + sums.shape)
    places = [x.ravel().astype(np.int32) for x in np.indices(full.shape)]
    return pa.RecordBatch.from_arrays([pa.array([part] * full.size), *map(pa.array, places), pa.array(full.ravel())], schema=SUMS)


def window_products(
    df: DataFrame,
    features: Sequence[str],
    grid: Grid = Grid(),
    length: int = DEFAULT_LENGTH,
    label: str = "target",
    split: str = "split",
    position: str = "split_row",
    used: str = "train",
) -> DataFrame:
    """``(a, b, i, j, value)``: sums over all windows of feature i of row a times feature j of row b.

    Row numbers count from 0, the oldest; row ``length`` is the one after the window, whose
    feature 0 is the label. Feature ``len(features)`` is 1 in each row. Windows are those
    of :func:`tidegrid.operators.sequences.sequence_windows` in the used split; rows must
    have all features and the label.
    """
    k = len(features)
    values = [*[named(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], named(label).cast("double").alias("y")]
    rows = df.filter(F.col(split) == used).select(F.col(grid.series).alias("_s"), F.col(position).alias("_p"), *values)
    sizes = rows.groupBy("_s").agg(F.max("_p").alias("_n")).filter(F.col("_n") > length)
    rows = settle(rows.join(sizes, "_s"))
    columns = [f"x{i}" for i in range(k)] + ["y"]

    haloed = with_halo(rows, F.col("_p"), max(grid.chunk_cells, length), length)
    keyed = haloed.select(F.xxhash64("_s", "_chunk").alias("_key"), "_p", F.col("_own").cast("int").alias("_own"), *columns)
    chunks = keyed.repartition("_key").sortWithinPartitions("_key", "_p").drop("_p")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((length + 1, k + 1, k + 2))
        for chunk in _stream(batches):
            own, x = int(np.flatnonzero(chunk[:, 0])[0]) if chunk[:, 0].any() else len(chunk), chunk[:, 1:]
            # features, the constant, the label
            x = np.column_stack([x[:, :k], np.ones(len(x)), x[:, k]])
            for d in range(length + 1):
                first = max(own, d)
                if first < len(x):
                    sums[d] += x[first - d : len(x) - d, : k + 1].T @ x[first:]
        yield _listed("whole", sums)

    ends = rows.filter((F.col("_p") <= length) | (F.col("_p") > F.col("_n") - length))
    ends = ends.select(F.xxhash64("_s").alias("_key"), "_p", "_n", *columns)
    ends = ends.repartition("_key").sortWithinPartitions("_key", "_p")

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, after = np.zeros((length, length, k + 1, k + 1)), np.zeros((length, k + 1))
        for series in _stream(batches):
            place, n, x = series[:, 0], int(series[0, 1]), series[:, 2:]
            x, y = np.column_stack([x[:, :k], np.ones(len(x))]), x[:, k]
            head, first_y = x[place <= length], y[place <= length]
            tail = x[place > n - length]
            for a in range(length):
                # the label comes L - a rows later, still among the first L
                after[a] += head[:a].T @ first_y[length - a :]
                for b in range(a, length):
                    d = b - a
                    square[a, b] += head[:a].T @ head[d:b]
                    # rows n - L + a + 1 .. n - d, as places in the tail
                    square[a, b] += tail[a : length - d].T @ tail[b:length]
        yield _listed("square", square)
        yield _listed("after", after[:, None, :, None])

    parts = rows.sparkSession.createDataFrame([], SUMS_SQL)
    for found in (chunks.mapInArrow(whole, SUMS_SQL), ends.mapInArrow(edges, SUMS_SQL)):
        parts = parts.unionByName(found.groupBy("part", "a", "b", "i", "j").agg(F.sum("value").alias("value")))
    parts = settle(parts)
    lagged = parts.filter("part = 'whole'").select(F.col("b").alias("d"), "i", "j", "value")
    starts = rows.sparkSession.range(length).select(F.col("id").cast("int").alias("a"))
    none = F.lit(0.0)
    between = lagged.filter((F.col("d") < length) & (F.col("j") <= k)).join(starts, F.col("a") + F.col("d") < length)
    between = between.select("a", (F.col("a") + F.col("d")).alias("b"), "i", "j", "value")
    square = parts.filter("part = 'square'").select("a", "b", "i", "j", F.col("value").alias("_less"))
    between = between.join(square, ["a", "b", "i", "j"], "left").select("a", "b", "i", "j", (F.col("value") - F.coalesce("_less", none)).alias("value"))
    label_sums = lagged.filter((F.col("d") > 0) & (F.col("j") == k + 1)).select((F.lit(length) - F.col("d")).alias("a"), "i", "value")
    after = parts.filter("part = 'after'").select("a", "i", F.col("value").alias("_less"))
    label_sums = label_sums.join(after, ["a", "i"], "left").select(
        "a", F.lit(length).alias("b"), "i", F.lit(0).alias("j"), (F.col("value") - F.coalesce("_less", none)).alias("value")
    )
    return between.unionByName(label_sums)


def train_window_linear(
    df: DataFrame,
    features: Sequence[str],
    grid: Grid = Grid(),
    length: int = DEFAULT_LENGTH,
    label: str = "target",
    ridge: float = 0.0,
    **names: str,
) -> WindowLinear:
    """Least squares of the label on the window before it, from :func:`window_products`.

    ``ridge`` is added to the variances of the features. The driver solves equations whose
    number is that of the weights.
    """
    k, size = len(features), length * len(features)
    product, after = np.zeros((length, length, k + 1, k + 1)), np.zeros((length, k + 1))
    # (L F)^2 / 2 numbers, whatever the number of rows
    for r in window_products(df, features, grid, length, label, **names).collect():
        if r["b"] == length:
            after[r["a"], r["i"]] = r["value"]
        else:
            product[r["a"], r["b"], r["i"], r["j"]] = r["value"]
            product[r["b"], r["a"], r["j"], r["i"]] = r["value"]
    rows = product[0, 0, k, k]
    if not rows:
        raise ValueError("no window of that length")
    mean = np.array([product[a, a, :k, k] for a in range(length)]).ravel() / rows
    mean_label = after[0, k] / rows
    left = product[:, :, :k, :k].transpose(0, 2, 1, 3).reshape(size, size) / rows - np.outer(mean, mean)
    right = after[:, :k].ravel() / rows - mean * mean_label
    weights = np.linalg.lstsq(left + ridge * np.eye(size), right, rcond=1e-10)[0]
    return WindowLinear(list(features), weights.reshape(length, k).tolist(), float(mean_label - mean @ weights), int(round(rows)))
