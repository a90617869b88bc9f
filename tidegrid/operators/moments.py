"""Counts, means, extremes and products of many columns in one scan.

Each task multiplies its rows as matrices: with X the values less a shift and M the mask
of present cells, M'M counts the rows two columns share, X'M and (X*X)'M are sums over
those rows, and X'X sums of products. A task returns one row per pair of columns, centred
on its own means, and pairs are added up by shuffle; nothing wider than a number leaves a
task, and a task holds four matrices of the columns' number squared.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.grid import named
from tidegrid.session import settle

_FIELDS = [("grp", pa.string()), ("i", pa.int32()), ("j", pa.int32()), ("n", pa.int64())]
_FIELDS += [(c, pa.float64()) for c in ("x", "y", "vx", "vy", "c", "lo", "hi")]
PARTIAL = pa.schema(_FIELDS)
PARTIAL_SQL = "grp string, i int, j int, n long, x double, y double, vx double, vy double, c double, lo double, hi double"
# A sum of squares this much smaller than what it was taken from is rounding.
ROUNDING = 1e-12


class _Products:
    """Running matrix products of one group's rows."""

    def __init__(self, first: np.ndarray) -> None:
        k = first.shape[1]
        present = ~np.isnan(first)
        # a typical value; of a constant column, its value
        self.shift = np.array([np.median(v[p]) if p.any() else 0.0 for v, p in zip(first.T, present.T)])
        self.n, self.s, self.d, self.q = (np.zeros((k, k)) for _ in range(4))
        self.lo, self.hi = np.full(k, np.inf), np.full(k, -np.inf)

    def add(self, values: np.ndarray) -> None:
        present = ~np.isnan(values)
        mask = present.astype(float)
        x = np.where(present, values - self.shift, 0.0)
        self.n += mask.T @ mask
        self.s += x.T @ mask
        self.d += (x * x).T @ mask
        self.q += x.T @ x
        self.lo = np.minimum(self.lo, np.where(present, values, np.inf).min(0))
        self.hi = np.maximum(self.hi, np.where(present, values, -np.inf).max(0))

    def rows(self, group: str | None) -> pa.RecordBatch:
        i, j = np.triu_indices(len(self.shift))
        seen = self.n[i, j] > 0
        i, j = i[seen], j[seen]
        n, sx, sy = self.n[i, j], self.s[i, j], self.s[j, i]

        def spread(a: np.ndarray, b: np.ndarray, total: np.ndarray) -> np.ndarray:
            v = self.d[a, b] - total * total / n
            return np.where(v <= ROUNDING * self.d[a, b], 0.0, v)

        own = i == j
        columns = [
            pa.array([group] * len(i), pa.string()), i.astype(np.int32), j.astype(np.int32), n.astype(np.int64),
            self.shift[i] + sx / n, self.shift[j] + sy / n, spread(i, j, sx), spread(j, i, sy), self.q[i, j] - sx * sy / n,
            pa.array(self.lo[i], mask=~own), pa.array(self.hi[i], mask=~own),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, t) if not isinstance(c, pa.Array) else c for c, t in zip(columns, PARTIAL.types)], schema=PARTIAL)


def pair_moments(
    df: DataFrame, columns: Sequence[str], by: str | None = None, groups: Sequence[str | None] = (None,)
) -> DataFrame:
    """``(grp, i, j, n, x, y, vx, vy, c, lo, hi)`` for each pair of columns i <= j, settled.

    Over the ``n`` rows of the group that have both columns: their means, sums of squares
    and of products about the means, and for a column with itself its extremes. Column
    number ``len(columns)`` is 1 in every row. NaN is missing. Rows of other groups do
    not count; pairs without a row are left out.
    """
    wanted = set(groups)
    values = [named(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]
    group = named(by).cast("string") if by else F.lit(None).cast("string")
    rows = df.select(group.alias("grp"), *values)
    k = len(columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str | None, _Products] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = np.ones((batch.num_rows, k + 1))
            for c in range(k):
                cells[:, c] = batch.column(c + 1).to_numpy(zero_copy_only=False)
            names = np.array(batch.column(0).to_pylist(), object)
            for name in set(names.tolist()) & wanted:
                part = cells[np.array([x == name for x in names])]
                if name not in sums:
                    sums[name] = _Products(part)
                sums[name].add(part)
        for name, products in sums.items():
            yield products.rows(name)

    partials = settle(rows.mapInArrow(work, PARTIAL_SQL))
    keys = ["grp", "i", "j"]
    # centres are subtracted from one of the tasks' means: equal means leave exact zeros
    least = partials.groupBy(*[F.col(c).alias(f"_{c}") for c in keys]).agg(F.min("x").alias("x0"), F.min("y").alias("y0"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    about = partials.join(least, same).select(*keys, "n", "x0", "y0", "vx", "vy", "c", "lo", "hi", (F.col("x") - F.col("x0")).alias("dx"), (F.col("y") - F.col("y0")).alias("dy"))
    n, dx, dy = F.col("n"), F.col("dx"), F.col("dy")
    added = about.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.min("x0").alias("x0"),
        F.min("y0").alias("y0"),
        *[F.sum(c).alias(c) for c in ("vx", "vy", "c")],
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.sum(n * dx).alias("sx"),
        F.sum(n * dy).alias("sy"),
        F.sum(n * dx * dx).alias("sxx"),
        F.sum(n * dy * dy).alias("syy"),
        F.sum(n * dx * dy).alias("sxy"),
    )
    mean_x, mean_y = F.col("sx") / n, F.col("sy") / n
    return settle(
        added.select(
            *keys,
            "n",
            (F.col("x0") + mean_x).alias("x"),
            (F.col("y0") + mean_y).alias("y"),
            (F.col("vx") + F.col("sxx") - F.col("sx") * mean_x).alias("vx"),
            (F.col("vy") + F.col("syy") - F.col("sy") * mean_y).alias("vy"),
            (F.col("c") + F.col("sxy") - F.col("sx") * mean_y).alias("c"),
            "lo",
            "hi",
        )
    )


def column_moments(pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(grp, column, total, n, mean, std, lo, hi)`` of each column, from its pair with itself."""
    k = len(columns)
    totals = pairs.filter((F.col("i") == k) & (F.col("j") == k)).select("grp", F.col("n").alias("total"))
    # one row per group and column, also where a column is never present
    every = totals.select("grp", "total", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("i"))
    own = pairs.filter(F.col("i") == F.col("j")).drop("j", "y", "vy", "c")
    joined = every.alias("e").join(own.alias("o"), F.col("e.grp").eqNullSafe(F.col("o.grp")) & (F.col("e.i") == F.col("o.i")), "left")
    names = F.array(*[F.lit(c) for c in columns])
    return joined.select(
        "e.grp",
        F.get(names, F.col("e.i")).alias("column"),
        "total",
        F.coalesce("n", F.lit(0)).alias("n"),
        F.col("x").alias("mean"),
        F.when(F.col("n") > 1, F.sqrt(F.col("vx") / (F.col("n") - 1))).alias("std"),
        "lo",
        "hi",
    )


def correlations(pairs: DataFrame, columns: Sequence[str], group: str | None = None) -> DataFrame:
    """Pearson correlation of all pairs of columns in a group, both ways round."""
    k = len(columns)
    names = F.array(*[F.lit(c) for c in columns])
    cells = pairs.sparkSession.range(k * k).select(
        F.expr(f"CAST(id div {k} AS INT)").alias("a"), F.expr(f"CAST(id % {k} AS INT)").alias("b")
    )
    mine = pairs.filter(F.col("grp").eqNullSafe(F.lit(group)))
    joined = cells.join(mine, (F.least("a", "b") == F.col("i")) & (F.greatest("a", "b") == F.col("j")), "left")
    varies = (F.col("vx") > 0) & (F.col("vy") > 0)
    r = F.col("c") / (F.sqrt("vx") * F.sqrt("vy"))
    return joined.select(
        F.get(names, F.col("a")).alias("column_a"),
        F.get(names, F.col("b")).alias("column_b"),
        F.when(varies, F.when(F.col("a") == F.col("b"), F.lit(1.0)).otherwise(r)).alias("correlation"),
    )
