"""Mixing sources to target weights by Poisson replication (operator 9), native throughout.

Each source's rate is its share of the wanted amount of text divided by the text it has.
A row's number of copies inverts the Poisson distribution of that mean at a uniform
number taken from a hash of seed and key, so the result depends on no order or layout.
Rows are exploded by their count and shuffled globally: a hash of seed, key and copy
number deals them out, and orders them within partitions.

Only per-source totals are aggregated (before the shuffle first); the table of
distributions has one row per source and is broadcast up to MAX_BROADCAST_SOURCES rows,
beyond that it is joined by a shuffle. No task sees a whole source.

Defined cases: a null source is a source of its own; null and empty texts have size 0
and are replicated like others of their source; a null key hashes like an empty one;
repeated rows get equal counts; sources without a given weight, or with weight 0, get no
copies; an empty table stays empty. All columns of the input are returned; they travel
in one struct, so helper columns cannot clash with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import scan

SEED = "mix-1"
EPOCHS = 1.0
TEMPERATURE = 0.5
MAX_BROADCAST_SOURCES = 100_000


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of a hash of the parts."""
    digest = F.md5(F.concat_ws(":", F.lit(SEED), *parts))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def named(column: Column) -> Column:
    """A join key that is never null."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def rates(docs: DataFrame, source: str, text: str, weights: dict[str | None, float] | None, epochs: float) -> DataFrame:
    """_source, rate: the mean number of copies of a source's rows.

    Without weights a source's target is its size to the power TEMPERATURE.
    """
    sizes = docs.groupBy(named(F.col(source)).alias("_source")).agg(
        F.sum(F.coalesce(F.char_length(F.col(text).cast("string")), F.lit(0)).cast("long")).alias("_size")
    )
    if weights is None:
        target = F.pow(F.col("_size").cast("double"), F.lit(TEMPERATURE))
    else:
        given = F.create_map(*[F.lit(x) for name, w in weights.items() for x in ("" if name is None else f"={name}", float(w))])
        target = F.coalesce(given[F.col("_source")], F.lit(0.0))
    sizes = sizes.withColumn("_target", target)
    # one row of totals; it reaches every row of this small table by a broadcast
    totals = sizes.agg(F.sum("_target").alias("_all"), F.sum("_size").alias("_text"))
    wanted = F.col("_target") / F.col("_all") * F.lit(float(epochs)) * F.col("_text")
    return sizes.join(F.broadcast(totals)).select("_source", F.coalesce(wanted / F.greatest("_size", F.lit(1)), F.lit(0.0)).alias("rate"))


def distribution(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... up to where the tail is below 2^-53."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    none = F.struct(F.lit(0.0).alias("log"), F.array(F.exp(-rate)).alias("sums"))

    def add(acc: Column, j: Column) -> Column:
        log = acc["log"] + F.ln(j.cast("double"))
        term = F.exp(j * F.ln(rate) - rate - log)
        return F.struct(log.alias("log"), F.concat(acc["sums"], F.array(F.element_at(acc["sums"], -1) + term)).alias("sums"))

    sums = F.aggregate(F.sequence(F.lit(1), last), none, add)["sums"]
    return F.when(rate > 0, sums).otherwise(F.array(F.lit(1.0)))


def replicate(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: dict[str | None, float] | None = None,
    epochs: float = EPOCHS,
    numbered: bool = False,
) -> DataFrame:
    """The input's columns, each row as often as drawn, in global random order.

    With `numbered`, the columns copy (from 1) and shuffle_key follow.
    """
    table = rates(docs, source, text, weights, epochs).select("_source", distribution(F.col("rate")).alias("_sums"))
    small = table.select("_source").limit(MAX_BROADCAST_SOURCES + 1).count() <= MAX_BROADCAST_SOURCES
    table = F.broadcast(table) if small else table
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), named(F.col(source)).alias("_source"), name.alias("_key"))
    drawn = packed.join(table, "_source").withColumn("_u", uniform(F.col("_key")))
    drawn = drawn.withColumn("_n", F.size(F.filter("_sums", lambda c: c <= F.col("_u")))).where("_n > 0")
    copies = drawn.select("row", "_key", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("copy"))
    order = F.md5(F.concat_ws(":", F.lit(SEED), F.lit("order"), "_key", F.col("copy").cast("string")))
    dealt = copies.select("row", "copy", order.alias("shuffle_key")).repartition(F.col("shuffle_key")).sortWithinPartitions("shuffle_key")
    out = [F.col("row").getField(c).alias(c) for c in docs.columns]
    return dealt.select(*out, "copy", "shuffle_key") if numbered else dealt.select(*out)


def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replicate(scan(spark, sf_dir, "documents"), numbered=True)


ORACLE = f"""
WITH sizes AS (
  SELECT source, sum(coalesce(length(text), 0))::BIGINT AS size FROM documents GROUP BY source
), targets AS (
  SELECT source, size, pow(size::DOUBLE, {TEMPERATURE}) AS target FROM sizes
), rates AS (
  SELECT source, target / (SELECT sum(target) FROM targets) * {EPOCHS}
                 * (SELECT sum(size) FROM sizes) / greatest(size, 1) AS rate
  FROM targets
), terms AS (
  SELECT source, j, exp(j * ln(rate) - rate - lgamma(j + 1)) AS term
  FROM rates, range(0, 200) t(j)
), sums AS (
  SELECT source, j, sum(term) OVER (PARTITION BY source ORDER BY j) AS below FROM terms
), lists AS (
  SELECT source, list(below ORDER BY j) AS below FROM sums GROUP BY source
), drawn AS (
  SELECT d.*, len(list_filter(below, lambda c: c <= (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5)
              / 4503599627370496.0)) AS n
  FROM documents d JOIN lists l ON d.source IS NOT DISTINCT FROM l.source
)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy,
       md5('{SEED}:order:' || coalesce(doc_id::VARCHAR, '') || ':' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(1, n + 1)) AS copy FROM drawn WHERE n > 0)
"""
