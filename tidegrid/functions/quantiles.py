"""Exact quantiles of columns of any length."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An aggregate keeps at most this many values of all its columns in one place.
EXACT_LIMIT = 1_000_000
SKETCH_ACCURACY = 10_000


@dataclass
class _Rank:
    """The value at one rank (from 0), and the open interval it is known to lie in."""

    measure: int
    rank: int
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    value: float | None = None

    def interior(self) -> str:
        """SQL for the measure where it lies in the interval, else NULL."""
        column = f"m{self.measure}"
        bounds = [f"{column} > {_sql(self.low)}"] if self.low is not None else []
        bounds += [f"{column} < {_sql(self.high)}"] if self.high is not None else []
        return f"CASE WHEN {' AND '.join(bounds) or 'TRUE'} THEN {column} END"


def _sql(number: float) -> str:
    return f"CAST('{number!r}' AS DOUBLE)"


def exact_quantiles(
    df: DataFrame,
    measures: Mapping[str, Column],
    probs: Sequence[float],
    limit: int = EXACT_LIMIT,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation; ``measures`` maps names to expressions.

    Spark's exact percentile gathers the distinct values of a column in one task.
    The measures share ``limit`` values: those of more than their share are narrowed
    first, see :func:`_select`; the result is exact either way. Only a few numbers per measure and quantile
    reach the driver. The frame is read more than once, so pass a settled one if
    it is costly.
    """
    names = list(measures)
    table = df.select(*[measures[m].cast("double").alias(f"m{i}") for i, m in enumerate(names)])
    sizes = table.agg(*[F.count(c).alias(c) for c in table.columns]).first()
    share = limit // max(1, len(names))
    short = [i for i in range(len(names)) if sizes[i] <= share]
    long = [i for i in range(len(names)) if sizes[i] > share]
    found: dict[str, list[float | None]] = {}
    if short:
        row = table.agg(
            *[F.percentile(f"m{i}", F.array(*[F.lit(float(p)) for p in probs])) for i in short]
        ).first()
        for i, values in zip(short, row):
            found[names[i]] = list(values) if values else [None] * len(probs)
    if long:
        targets = {(i, p): (sizes[i] - 1) * p for i in long for p in probs}
        wanted = sorted({(i, k) for (i, _), at in targets.items() for k in _neighbours(at)})
        ranks = {(i, k): _Rank(i, k, sizes[i]) for i, k in wanted}
        _select(table, list(ranks.values()), limit, accuracy)
        for i in long:
            found[names[i]] = [_interpolated(ranks, i, targets[i, p]) for p in probs]
    return {m: found[m] for m in names}


def _neighbours(position: float) -> tuple[int, int]:
    return math.floor(position), math.ceil(position)


def _interpolated(ranks: Mapping[tuple[int, int], _Rank], i: int, position: float) -> float:
    lower, upper = (ranks[i, k].value for k in _neighbours(position))
    return lower + (upper - lower) * (position - math.floor(position))


def _select(table: DataFrame, ranks: list[_Rank], limit: int, accuracy: int) -> None:
    """Find the value at each rank by narrowing the interval around it.

    Two values of a bounded sketch cut the interval in three; one counting pass
    tells which part, or which of the two values, holds the rank. Each round keeps
    about one part in ``accuracy / 4``, so two or three rounds do for any table,
    and what is left is small enough for the exact aggregate.
    """
    share = max(1, limit // max(1, len(ranks)))
    while wide := [r for r in ranks if r.value is None and r.inside > share]:
        _narrow(table, wide, accuracy)
    rest = [r for r in ranks if r.value is None]
    if rest:
        # the middle of the rank's own step, so that rounding cannot hit a neighbour
        row = table.agg(
            *[
                F.expr(
                    f"percentile_disc({_sql((r.rank - r.below + 0.5) / r.inside)}) "
                    f"WITHIN GROUP (ORDER BY {r.interior()})"
                ).alias(f"v{i}")
                for i, r in enumerate(rest)
            ]
        ).first()
        for i, r in enumerate(rest):
            r.value = row[i]


def _narrow(table: DataFrame, wide: list[_Rank], accuracy: int) -> None:
    margin = 2.0 / accuracy
    sketches = []
    for i, r in enumerate(wide):
        share = (r.rank - r.below) / max(r.inside - 1, 1)
        ends = [max(share - margin, 0.0), min(share + margin, 1.0)]
        sketches.append(F.percentile_approx(F.expr(r.interior()), ends, accuracy).alias(f"s{i}"))
    cuts = [tuple(pair) for pair in table.agg(*sketches).first()]

    counts = []
    for i, (r, (a, b)) in enumerate(zip(wide, cuts)):
        x, lo, hi = r.interior(), _sql(a), _sql(b)
        counts += [
            F.expr(f"count_if({x} < {lo})").alias(f"under{i}"),
            F.expr(f"count_if({x} = {lo})").alias(f"first{i}"),
            F.expr(f"count_if({x} > {lo} AND {x} < {hi})").alias(f"between{i}"),
            F.expr(f"count_if({x} = {hi})").alias(f"second{i}"),
        ]
    row = table.agg(*counts).first()
    for i, (r, (a, b)) in enumerate(zip(wide, cuts)):
        under, first, between = row[f"under{i}"], row[f"first{i}"], row[f"between{i}"]
        second = row[f"second{i}"] if b > a else 0
        at = r.rank - r.below
        if at < under:
            r.high, r.inside = a, under
        elif at < under + first:
            r.value = a
        elif at < under + first + between:
            r.low, r.high = a, b
            r.below, r.inside = r.below + under + first, between
        elif at < under + first + between + second:
            r.value = b
        else:
            passed = under + first + between + second
            r.low, r.below, r.inside = b, r.below + passed, r.inside - passed
