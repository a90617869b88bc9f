"""Quality rules with risk-controlled thresholds (operator 8).

Base rules have fixed limits. On top of them, a stratum (language) has one path of
cutoffs, from mild to strict: at level t every ratio of RATIOS has as its cutoff the
lowest step that at most t / LEVELS * WIDEST of the stratum's unlabelled rows reach, and
a text is dropped when any ratio reaches its cutoff. So a row has a level from which on it
is dropped, and what stricter levels drop contains what milder ones do. Strata without
unlabelled rows have cutoffs at equal steps.

How far a stratum goes is decided by labelled rows. At level t, k of its n good rows (those
that pass the base rules) are dropped; the exact binomial test P(Bin(n, ALPHA) <= k) <= d
bounds the rate of false rejections, by all ratios together, by ALPHA with confidence
1 - d. Levels are tested from the mildest on, and the last one before the first failure is
taken: a fixed sequence, which needs no correction within a stratum. d is DELTA shared
by the strata; what a stratum has that passes all its levels goes to those that do not, in
equal parts (a Holm step for sequences). A stratum with too few labels to prove anything
drops nothing.

The good rows are to be independent draws: a labelled key counts once (its smallest stratum,
text and steps, if it stands on several rows), and equal texts of a stratum count once.

Defined cases: null or empty texts have zero counts and fail the base rule; a null
language is a stratum of its own; labels of one document given twice count once, as bad
if any is bad; labels without a document or without a value are ignored; an empty table
gives an empty result. Repeated rows are judged one by one. Columns other than key,
text and stratum are never read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from tidegrid.llm.common import WordHashes, join_checked, map_rows, scan, texts, written
from tidegrid.llm.structure import SIGN, SYMBOL, UPPER, measure

ALPHA = 0.05
DELTA = 0.05
STEPS = 40
# Levels of a path, and the share of unlabelled rows that the strictest one may drop by a ratio.
LEVELS = 40
WIDEST = 0.2
MAX_BROADCAST_STRATA = 10_000
# Fixed values of the base rules.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

RATIOS = ("symbols", "dup_lines", "repeats", "capitals", "signs")


def ratios(c) -> list[float]:
    """The values the cutoffs apply to, each between 0 and 1."""
    chars, letters = max(1, c.word_chars), max(1, int(c.kinds[UPPER:].sum()))
    return [
        c.kinds[SYMBOL] / chars,
        c.n_dup_lines / max(1, c.n_lines),
        c.n_repeat_words / max(1, c.n_words),
        c.kinds[UPPER] / letters,
        c.kinds[SIGN] / chars,
    ]


def counted(docs: DataFrame, key: str, text: str, stratum: str) -> DataFrame:
    """key, stratum, the base counts, a hash of the text, and each ratio's step (value times
    STEPS, down)."""
    dtype = docs.schema[key].dataType

    def make():
        memory = WordHashes()

        def work(columns):
            keys, strata, column = columns
            rows = [measure(t, memory) for t in texts(column)]
            steps = [[min(STEPS, int(v * STEPS)) for v in ratios(c)] for c in rows]
            return [
                keys,
                strata,
                [c.n_words for c in rows],
                [c.word_chars for c in rows],
                [int(c.kinds[SYMBOL]) for c in rows],
                [c.n_dup_lines for c in rows],
                [c.n_repeat_words for c in rows],
                [xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in texts(column)],
                steps,
            ]

        return work

    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_text"]
    fields = [(key, to_arrow_type(dtype)), ("stratum", pa.string())] + [(c, pa.int64()) for c in counts]
    schema = f"`{key}` {dtype.simpleString()}, stratum string, " + ", ".join(f"{c} long" for c in counts)
    rows = map_rows(
        docs.select(F.col(key), F.coalesce(F.col(stratum).cast("string"), F.lit("")), F.col(text).cast("string")),
        make,
        schema + ", steps array<int>",
        pa.schema([*fields, ("steps", pa.list_(pa.int32()))]),
    )
    return rows.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def proven(k: int, n: int, rate: float, miss: float) -> bool:
    """Whether k of n excludes rates above `rate`: P(Bin(n, rate) <= k) <= miss."""
    if n == 0:
        return False
    i = np.arange(k + 1)
    log = np.array([math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) for j in i])
    log += i * math.log(rate) + (n - i) * math.log1p(-rate)
    return float(np.exp(log - log.max()).sum()) * math.exp(log.max()) <= miss


def last_level(dropped: list[int], n: int, rate: float, miss: float) -> int:
    """dropped[t - 1]: good rows that level t drops. The last level before the first that is
    not proven; 0 if there is none."""
    for level, k in enumerate(dropped):
        if k > rate * n or not proven(k, n, rate, miss):
            return level
    return len(dropped)


def paths(rows: DataFrame) -> DataFrame:
    """stratum, levels: for each ratio and step the level from which on it drops (LEVELS + 1:
    never), by the shares of the given rows."""
    cells = rows.select("stratum", F.posexplode("steps").alias("ratio", "step")).groupBy("stratum", "ratio", "step").count()
    # strata have at most 41 rows per ratio from here on
    above = Window.partitionBy("stratum", "ratio").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("stratum", "ratio")
    shares = cells.select("stratum", "ratio", "step", F.sum("count").over(above).alias("reach"), F.sum("count").over(every).alias("n"))
    level = F.greatest(F.lit(1), F.ceil(F.col("reach") * LEVELS / (F.col("n") * WIDEST)).cast("int"))
    cell = F.struct("ratio", "step", F.least(level, F.lit(LEVELS + 1)).alias("level"))
    listed = shares.groupBy("stratum").agg(F.collect_list(cell).alias("cells"))

    def of_step(ratio: Column, step: Column) -> Column:
        # a step that no row has is reached by the rows of the next step that some have
        reached = F.filter("cells", lambda c: (c["ratio"] == ratio) & (c["step"] >= step))
        return F.coalesce(F.array_max(F.transform(reached, lambda c: c["level"])), F.lit(1))

    numbers = F.sequence(F.lit(1), F.lit(STEPS))
    by_ratio = F.transform(F.sequence(F.lit(0), F.lit(len(RATIOS) - 1)), lambda r: F.transform(numbers, lambda s: of_step(r, s)))
    return listed.select("stratum", by_ratio.alias("levels"))


def level_of(steps: Column, levels: Column, ratio: int) -> Column:
    """The level from which on a ratio drops a row; the lowest step never does."""
    even = F.transform(F.sequence(F.lit(1), F.lit(STEPS)), lambda s: F.ceil((STEPS - s + 1) * LEVELS / STEPS).cast("int"))
    mine = F.coalesce(F.get(levels, F.lit(ratio)), even)
    return F.coalesce(F.get(mine, F.get(steps, F.lit(ratio)) - 1), F.lit(LEVELS + 1))


def row_level(steps: Column, levels: Column) -> Column:
    return F.least(*[level_of(steps, levels, r) for r in range(len(RATIOS))])


def risk_controlled(counts: DataFrame, alpha: float, delta: float) -> DataFrame:
    """stratum, chosen: the level each stratum goes to, from its good rows per level."""
    cells = counts.groupBy("stratum").agg(F.collect_list(F.struct("level", "count")).alias("cells"))
    cells = cells.checkpoint()

    def chosen(miss: float):
        @F.pandas_udf("int")
        def of(strata: pd.Series) -> pd.Series:
            def one(stratum) -> int:
                table = np.zeros(LEVELS + 2, np.int64)
                for cell in stratum:
                    table[cell["level"]] += cell["count"]
                return last_level(table.cumsum()[1 : LEVELS + 1].tolist(), int(table.sum()), alpha, miss)

            return strata.map(one)

        return cells.select("stratum", of("cells").alias("chosen"))

    strata, through = cells.count(), 0
    while True:
        # strata that pass all levels need no more of delta than they had
        found = chosen(delta / max(1, strata - through))
        now = found.where(F.col("chosen") == LEVELS).count()
        if now in (through, strata):
            return found
        through = now


def cutoffs(rows: DataFrame, labels: DataFrame, key: str, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """stratum, levels, chosen: each stratum's path and how far it goes."""
    marks = labels.where(F.col("quality").isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min("quality").alias("_good"))
    passed = rows.where(~F.col("base_failed"))
    ways = written(paths(passed.join(marks, F.col(key) == F.col("_key"), "left_anti")), "rule-paths")
    good = passed.join(marks.where("_good = 1"), F.col(key) == F.col("_key"), "left_semi")
    draws = good.groupBy(key).agg(F.min(F.struct("stratum", "_text", "steps")).alias("d")).select("d.*")
    draws = draws.groupBy("stratum", "_text").agg(F.min("steps").alias("steps"))
    leveled = join_checked(draws, ways, ["stratum"], "left", MAX_BROADCAST_STRATA)
    counts = leveled.select("stratum", row_level(F.col("steps"), F.col("levels")).alias("level")).groupBy("stratum", "level").count()
    return risk_controlled(counts, alpha, delta).join(ways, "stratum", "left").select("stratum", "levels", "chosen")


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """key, stratum, base counts, base_failed, broken (ratios at their cutoff), kept."""
    rows = written(counted(docs, key, text, stratum), "rule-counts")
    limits = written(cutoffs(rows, labels, key), "rule-limits")
    joined = join_checked(rows, limits, ["stratum"], "left", MAX_BROADCAST_STRATA)
    hits = [F.when(level_of(F.col("steps"), F.col("levels"), r) <= F.coalesce("chosen", F.lit(0)), F.lit(name)) for r, name in enumerate(RATIOS)]
    return joined.withColumn("broken", F.array_compact(F.array(*hits))).select(
        key,
        "stratum",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "broken",
        (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judge(scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "labels"))
    return rows.drop("stratum", "broken")
