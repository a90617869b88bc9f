"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import time
from dataclasses import replace
from statistics import median

from pyspark.sql import DataFrame, SparkSession

from tidegrid.catalog import HOURLY, all_queries
from tidegrid.operators.features import feature_table
from tidegrid.plans.cleaning import clean_readings
from tidegrid.session import build_session
from tidegrid.sources import testdata

HEADLINE = (
    "interpolate_linear",
    "clean_readings_sparse",
    "clean_readings_daily",
    "feature_table",
    "feature_table_sparse",
    "time_split",
    "forecast_recursive",
    "drift_report",
    "iqr_outliers",
    "correlation_matrix",
    "run_artifacts",
    "runs_leaderboard",
    "registry_models",
)
# Seconds above which a query is not repeated.
LONG = 15
# Longer than any series: every series is one chunk.
WHOLE_SERIES = replace(HOURLY, chunk_cells=1 << 40)


def features_unchunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = testdata.readings_sparse(spark, sf_dir)
    return feature_table(clean_readings(readings, WHOLE_SERIES)[0], WHOLE_SERIES)


def seconds(query, spark: SparkSession, sf_dir: str) -> float:
    """The median of three runs; a query that takes long is run once."""
    times: list[float] = []
    while len(times) < 3 and (not times or times[0] < LONG):
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.log.level": "ERROR",
        },
    )
    queries = all_queries()
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    times = {name: seconds(queries[name], spark, sf_dir) for name in HEADLINE}
    times["feature_table_sparse_unchunked"] = seconds(features_unchunked, spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
