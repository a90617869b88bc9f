"""Label encoding of the weather code by string order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.grid import named
from tidegrid.operators.regrid import MISSING_LABEL, label_of

# Up to this many categories are ranked on the driver and broadcast. More are
# ranked in ranges by the cluster and joined as Spark sees fit.
MAX_SMALL_ENCODING = 10_000
RANGE_SPLITS = 1_000
UNSEEN_CODE = -1
# Keys the holes of a grid are spread over in the join.
HOLE_SPREAD = 1_000


def weather_column(columns: list[str]) -> str | None:
    """The first column whose name starts with ``weather_code``."""
    return next((c for c in columns if c.startswith("weather_code")), None)


def fit_encoding(df: DataFrame, column: str, with_missing: bool = False) -> DataFrame:
    """Table ``(label, code)``: codes 0.. in string order; missing is the label 'nan'.

    ``with_missing`` adds that label also if no row of ``df`` is missing, for a
    frame that has yet to be laid on the grid.
    """
    return rank_labels(df.select(label_of(column).alias("label")).distinct(), with_missing)


def rank_labels(labels: DataFrame, with_missing: bool = False) -> DataFrame:
    """:func:`fit_encoding` of a table of distinct labels."""
    if with_missing:
        missing = labels.sparkSession.range(1).select(F.lit(MISSING_LABEL).alias("label"))
        labels = labels.unionByName(missing).distinct()
    found = [r["label"] for r in labels.limit(MAX_SMALL_ENCODING + 1).collect()]
    if len(found) > MAX_SMALL_ENCODING:
        return rank_in_ranges(labels)
    # Spark orders strings by their UTF-8 bytes
    ordered = sorted(found, key=lambda label: label.encode())
    rows = [(label, code) for code, label in enumerate(ordered)]
    return F.broadcast(labels.sparkSession.createDataFrame(rows, "label string, code int"))


def rank_in_ranges(labels: DataFrame) -> DataFrame:
    """Rank distinct labels without bringing them together: each range on its own."""
    # any cut points give the same ranks; a fixed-size sample makes the ranges even
    sample = labels.orderBy(F.xxhash64("label")).limit(RANGE_SPLITS).collect()
    cuts = F.array(*[F.lit(r["label"]) for r in sorted(sample)])
    ranged = labels.withColumn(
        "part", F.size(F.filter(cuts, lambda cut: cut <= F.col("label")))
    )
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        ranged.groupBy("part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    within = F.row_number().over(Window.partitionBy("part").orderBy("label")) - 1
    # at most RANGE_SPLITS + 1 rows
    return ranged.join(F.broadcast(offsets), "part").select(
        "label", (F.col("offset") + within).cast("int").alias("code")
    )


def encode(
    df: DataFrame, column: str, encoding: DataFrame, output: str = "weather_code"
) -> DataFrame:
    """Replace the column by its code; labels the encoding does not know become -1."""
    table = encoding.select(F.col("label").alias("_label"), F.col("code").alias("_code"))
    # all holes of a sparse grid carry the missing label: its code comes from one row, and
    # for the join each hole gets one of many keys that match nothing
    missing = encoding.filter(F.col("label") == MISSING_LABEL).agg(F.max("code").alias("_missing"))
    label = label_of(column)
    hole = label == MISSING_LABEL
    nothing = F.concat(F.lit("\u0000"), F.pmod(F.hash(*map(named, df.columns)), F.lit(HOLE_SPREAD)).cast("string"))
    keyed = df.withColumn("_hole", hole).withColumn("_label", F.when(hole, nothing).otherwise(label))
    joined = keyed.join(table, "_label", "left").join(F.broadcast(missing))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (column, output)]
    code = F.when(F.col("_hole"), F.col("_missing")).otherwise(F.col("_code"))
    return joined.select(*kept, F.coalesce(code, F.lit(UNSEEN_CODE)).alias(output))
