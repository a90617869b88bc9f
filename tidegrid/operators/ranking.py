"""Ranks within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.session import join_counted, settle


def rank_groups(df: DataFrame, by: str, order: Sequence[Column], output: str = "rank") -> DataFrame:
    """Number the rows of each group from 1 in the given order, which must have no ties.

    Rows are sorted by group and order in ranges, which cut large groups; a row's number is
    its place in its range plus the rows of its group in the ranges before. Groups must
    not be NULL. The frame is settled.
    """
    ranged = settle(df.repartitionByRange(by, *order).withColumn("_part", F.spark_partition_id()))
    earlier = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per group and range it has rows in
    offsets = ranged.groupBy(by, "_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = settle(offsets.select(by, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")))
    within = F.row_number().over(Window.partitionBy(by, "_part").orderBy(*order))
    placed = join_counted(ranged, offsets, [by, "_part"])
    return placed.withColumn(output, (F.col("_offset") + within).cast("int")).drop("_part", "_offset")
