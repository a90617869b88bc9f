"""Tables of the library's shapes, derived from the given test tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.grid import Grid
from tidegrid.operators.experiments import parse_summary
from tidegrid.session import shared_folder

HOURLY = Grid()
DAILY = Grid(freq_seconds=86_400)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hour() -> Column:
    return HOURLY.floor("ts")


def readings_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per event type: mean and maximum per hour, and a weather code."""
    events = table(spark, sf_dir, "events")
    return events.groupBy(F.col("event_type").alias("series_id"), _hour().alias("ts")).agg(
        F.avg("value").alias("target"),
        F.max("value").alias("aux"),
        (F.min("event_id") % 12).cast("string").alias("weather_code"),
    )


def readings_cyclic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly readings with a daily course in the target, which models can learn.

    Its sine is two and a half times its cosine, and both exceed what the readings add.
    """
    angle = F.hour("ts") * (2 * math.pi) / 24
    course = F.lit(150.0) * F.sin(angle) + F.lit(60.0) * F.cos(angle)
    return readings_hourly(spark, sf_dir).withColumn("target", F.col("target") * 0.2 + course)


def readings_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sparse series per user."""
    events = table(spark, sf_dir, "events")
    return events.groupBy(
        F.col("user_id").cast("string").alias("series_id"), _hour().alias("ts")
    ).agg(F.avg("value").alias("target"))


def readings_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily series over several years per nation."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return joined.groupBy(
        F.col("c_nationkey").cast("string").alias("series_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("ts"),
    ).agg((F.sum("o_totalprice") / 10000).alias("target"))


def readings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as text, some unreadable, and missing values."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series_id"),
        F.when(F.col("event_id") % 97 == 0, "not-a-time")
        .otherwise(F.col("ts").cast("string"))
        .alias("time_text"),
        F.when(F.col("event_id") % 11 != 0, F.col("value")).alias("target"),
    )


def readings_offgrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly readings with further ones at the half hour."""
    hourly = readings_hourly(spark, sf_dir)
    copies = F.when(F.col("aux") > 100, F.array(F.lit(0), F.lit(30))).otherwise(F.array(F.lit(0)))
    zero = F.lit(0)
    return hourly.withColumn("_minutes", F.explode(copies)).select(
        "series_id",
        (F.col("ts") + F.make_dt_interval(zero, zero, F.col("_minutes"), zero)).alias("ts"),
        F.when(F.col("_minutes") > 0, F.col("target") + 1).otherwise(F.col("target")).alias("target"),
    )


def readings_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly readings as a file would hold them: names with units, times as text.

    Rows of one weather code come once more with an unreadable time.
    """
    times = F.when(F.col("weather_code") == "0", F.array(F.col("ts").cast("string"), F.lit("soon")))
    return readings_hourly(spark, sf_dir).select(
        F.col("series_id").alias("station name"),
        F.explode(times.otherwise(F.array(F.col("ts").cast("string")))).alias("time"),
        F.col("target").alias("pm2_5 (μg/m³)"),
        F.col("aux").alias("wind speed ()"),
        F.col("weather_code").alias("weather_code ()"),
        F.col("aux").alias("snowfall (cm)"),
    )


def events_csv(spark: SparkSession, sf_dir: str) -> str:
    """The events as CSV lines in a new shared folder, some of them broken; its path."""
    key = F.col("event_id")
    value = F.when(key % 97 == 0, "n/a").otherwise(F.col("value").cast("string"))
    fields = [key.cast("string"), F.col("ts").cast("string"), F.col("event_type"), value]
    line = F.concat_ws(",", *fields)
    short, long = F.concat_ws(",", *fields[:2]), F.concat_ws(",", *fields, F.lit("more"))
    broken = F.when(key % 89 == 0, short).when(key % 83 == 0, long).otherwise(line)
    path = shared_folder(spark, "events-csv")
    table(spark, sf_dir, "events").select(broken.alias("value")).write.text(path)
    return path


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One experiment run per order, with a JSON summary read back into a struct."""
    key = F.col("o_orderkey")
    single = F.when(key % 10 != 0, (500 + key * 37 % 500).cast("double") / 1000)
    multi = F.when(key % 9 != 0, (400 + key * 53 % 500).cast("double") / 1000)

    def metrics(accuracy: Column) -> Column:
        return F.when(
            key % 7 != 0,
            F.struct(
                accuracy.alias("accuracy"),
                (1 - accuracy).alias("mape"),
                ((1 - accuracy) * 40).alias("mae"),
            ),
        )

    summary = F.struct(
        metrics(single).alias("single_step_metrics"),
        metrics(multi).alias("multi_step_metrics"),
        F.when(key % 13 != 0, F.col("o_totalprice") / 50).alias("_runtime"),
    )
    state = (
        F.when(F.col("o_orderstatus") == "F", "finished")
        .when(F.col("o_orderstatus") == "O", "running")
        .when(key % 2 == 0, "failed")
        .otherwise("crashed")
    )
    raw = table(spark, sf_dir, "orders").select(
        key.alias("run_id"),
        F.concat(F.lit("run-"), key.cast("string")).alias("name"),
        state.alias("state"),
        F.col("o_orderdate").alias("created_at"),
        F.when(key % 23 != 0, F.col("o_custkey").cast("string")).alias("user_id"),
        F.array("o_orderpriority").alias("tags"),
        F.to_json(summary).alias("summary_json"),
    )
    return parse_summary(raw)


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One logged artifact per line item; those of every third order go to the next run."""
    kind = (
        F.when(F.col("l_returnflag") == "R", "model")
        .when(F.col("l_returnflag") == "A", "processor")
        .otherwise("run_log")
    )
    order = F.col("l_orderkey")
    return table(spark, sf_dir, "lineitem").select(
        F.when(order % 3 == 0, order + 1).otherwise(order).alias("run_id"),
        F.concat(F.lit("model-"), F.col("l_partkey").cast("string")).alias("name"),
        F.concat(F.lit("v"), F.col("l_linenumber").cast("string")).alias("version"),
        kind.alias("type"),
        F.col("l_suppkey").alias("seq"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One registry version per part; some have no run."""
    key, size = F.col("p_partkey"), F.col("p_size") % 5
    aliases = (
        F.when(size == 0, F.array(F.lit("production"), F.lit("latest")))
        .when(size == 1, F.array(F.lit("Staging")))
        .when(size == 2, F.array(F.lit("staging-latest")))
        .when(size == 3, F.array(F.lit("latest")))
        .otherwise(F.array().cast("array<string>"))
    )
    # ISO text with and without a time, other text, nothing
    day = F.concat(F.lit("2024-"), F.lpad((key % 12 + 1).cast("string"), 2, "0"), F.lit("-15"))
    created = (
        F.when(key % 11 == 0, "")
        .when(key % 13 == 0, "last spring")
        .when(key % 5 == 0, day)
        .otherwise(F.concat(day, F.lit("T08:30:00")))
    )
    return table(spark, sf_dir, "part").select(
        key.alias("version_id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("v"), key.cast("string")).alias("version"),
        F.when(key % 17 != 0, key * 3).alias("run_id"),
        aliases.alias("aliases"),
        created.alias("created_at"),
        F.when(key % 4 != 0, F.concat(F.lit("about "), F.col("p_name"))).alias("description"),
    )


def promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A promotion request per part; a third lack a target, some name no version."""
    key = F.col("p_partkey")
    target = F.when(key % 3 == 0, "production").when(key % 3 == 1, "staging")
    version = F.when(key % 19 == 0, "v-none").otherwise(
        F.concat(F.lit("v"), key.cast("string"))
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_name").alias("name"), version.alias("version"), target.alias("target")
    )
