"""Reading of raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.grid import named
from tidegrid.operators.naming import normalize_columns
from tidegrid.operators.regrid import nan_to_null, parse_time

FORMATS = ("csv", "json", "parquet", "orc")
BROKEN = "_unreadable"


def scan_readings(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Read a table of readings from any path Spark can open; NaN becomes NULL.

    Give the schema for text formats: without one Spark reads the files twice.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt}; one of {FORMATS}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("nanValue", "NaN")
        if schema is None:
            reader = reader.option("inferSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return nan_to_null(reader.options(**options).load(path))


def scan_checked(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv", **options: str
) -> tuple[DataFrame, DataFrame]:
    """Read CSV or JSON lines in two tables: typed rows, and records that do not parse.

    The second one is ``(file, record, reason)``; the reason names the first column whose
    text is no value of its type, or tells that the record as a whole cannot be read (a
    wrong number of fields, broken JSON). Empty fields are NULL. Both tables read the files
    when they are used, and no record is in both or in none.
    """
    if fmt not in ("csv", "json"):
        raise ValueError(f"unknown text format {fmt}")
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted.fields])
    reader = spark.read.format(fmt).schema(texts.add(BROKEN, T.StringType()))
    reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN, **options)
    columns = [f.name for f in wanted.fields]
    rows = reader.load(path).select(
        F.col("_metadata.file_path").alias("_file"), BROKEN, *[named(c).alias(f"_t{i}") for i, c in enumerate(columns)]
    )
    typed = [F.expr(f"try_cast(_t{i} AS {f.dataType.simpleString()})") for i, f in enumerate(wanted.fields)]
    reason = F.when(F.col(BROKEN).isNotNull(), F.lit("unreadable record"))
    for i, f in enumerate(wanted.fields):
        odd = F.col(f"_t{i}").isNotNull() & typed[i].isNull()
        reason = reason.when(odd, F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
    judged = rows.withColumn("reason", reason)
    good = judged.filter(F.col("reason").isNull()).select(*[t.alias(c) for t, c in zip(typed, columns)])
    record = F.to_csv(F.struct(*[f"_t{i}" for i in range(len(columns))])) if fmt == "csv" else F.to_json(
        F.struct(*[F.col(f"_t{i}").alias(c) for i, c in enumerate(columns)])
    )
    bad = judged.filter(F.col("reason").isNotNull()).select(
        F.col("_file").alias("file"), F.coalesce(BROKEN, record).alias("record"), "reason"
    )
    return nan_to_null(good), bad


def as_series(
    raw: DataFrame,
    time: str = "time",
    series: str | None = None,
    ts: str = "ts",
    series_id: str = "series_id",
) -> DataFrame:
    """Normalise names, parse the time column and add the series key if there is none."""
    df = normalize_columns(raw)
    if isinstance(df.schema[time].dataType, T.StringType):
        df = parse_time(df, time, ts)
    else:
        rest = [F.col(f"`{c}`") for c in df.columns if c != time]
        df = df.select(F.col(time).cast("timestamp_ntz").alias(ts), *rest)
        df = df.filter(F.col(ts).isNotNull())
    if series is None:
        return df.withColumn(series_id, F.lit("all"))
    return df.withColumnRenamed(series, series_id)
