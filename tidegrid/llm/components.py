"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import shuffles_removed
from tidegrid.session import ensure_checkpoint_dir


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node it reaches) of every node of links (a, b).

    Each round hangs the larger neighbours of a node below its smallest one (large
    star), then a node's smaller neighbours too (small star), until nothing changes. A
    round keeps at most as many links as before; hot nodes are summed up before the
    shuffle, and their joins can be split. Every round ends in a checkpoint.
    """
    ensure_checkpoint_dir(links.sparkSession)
    spark = links.sparkSession
    with shuffles_removed(spark):
        edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    mark = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_least"))
        least = least.select("node", F.least("node", "_least").alias("low"))
        large = both.join(least, F.col("a") == F.col("node")).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        small = large.join(low, F.col("a") == F.col("node")).select(F.explode(F.array(F.struct(F.col("a"), F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
        with shuffles_removed(spark):
            edges = small.select("e.a", "e.b").where("a <> b").distinct().checkpoint()
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("node", F.col("node").alias("root")))
