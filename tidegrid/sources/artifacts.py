"""Saving and loading of fitted state, models, metrics and result tables."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.operators.scaling import bounds_table, read_bounds
from tidegrid.plans.dataset import Fitted
from tidegrid.sources.files import file_exists, list_folders

# Sub-paths under the base path.
MODELS, PROCESSORS, METRICS, TABLES = "models", "processors", "metrics", "reports"


def save_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").json(path)


def load_metrics(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def save_processor(spark: SparkSession, fitted: Fitted, path: str) -> None:
    """Write encoding, scaling and feature list as small Parquet tables."""
    bounds_table(spark, fitted.bounds).write.mode("overwrite").parquet(f"{path}/scaling")
    names = [(i, c, False, c in fitted.texts) for i, c in enumerate(fitted.features)]
    names.append((len(names), fitted.target, True, False))
    schema = "position int, column string, is_target boolean, is_text boolean"
    columns = spark.createDataFrame(names, schema)
    columns.write.mode("overwrite").parquet(f"{path}/columns")
    empty = spark.createDataFrame([], "label string, code int")
    encoding = fitted.encoding if fitted.encoding is not None else empty
    encoding.write.mode("overwrite").parquet(f"{path}/encoding")


def load_processor(spark: SparkSession, path: str) -> Fitted:
    columns = spark.read.parquet(f"{path}/columns").orderBy("position").collect()
    encoding = spark.read.parquet(f"{path}/encoding")
    return Fitted(
        target=next(r["column"] for r in columns if r["is_target"]),
        features=[r["column"] for r in columns if not r["is_target"]],
        bounds=read_bounds(spark.read.parquet(f"{path}/scaling")),
        encoding=None if encoding.isEmpty() else encoding,
        texts=[r["column"] for r in columns if r["is_text"]],
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_artifacts(
    spark: SparkSession,
    base: str,
    model: PipelineModel,
    fitted: Fitted,
    metrics: DataFrame,
    tables: Mapping[str, DataFrame],
) -> None:
    """Everything a training run leaves behind, each kind in its own folder."""
    save_model(model, f"{base}/{MODELS}")
    save_processor(spark, fitted, f"{base}/{PROCESSORS}")
    save_metrics(metrics, f"{base}/{METRICS}")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{base}/{TABLES}/{name}")


# --- published sets ------------------------------------------------------------------------

MANIFEST = "manifest"
MANIFEST_SCHEMA = "path string, bytes bigint, md5 string"


@dataclass
class Published:
    """A complete set: its folder, its fitted state, and its model if it has one."""

    folder: str
    fitted: Fitted | None
    model: PipelineModel | None


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """Path below the folder, size and checksum of every file but the manifest's."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    below = F.regexp_extract("path", f"/{re.escape(folder.rstrip('/').rsplit('/', 1)[-1])}/(.*)$", 1)
    listed = found.select(below.alias("path"), F.col("length").alias("bytes"), F.md5("content").alias("md5"))
    return listed.filter(~F.col("path").startswith(f"{MANIFEST}/"))


def publish(
    spark: SparkSession,
    base: str,
    fitted: Fitted | None = None,
    model: PipelineModel | None = None,
    metrics: DataFrame | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> str:
    """Write a new set below ``base`` and return its folder.

    A manifest of all files with their checksums is written last: until it is there, readers
    keep to the set before. Nothing that was published is overwritten.
    """
    folder = f"{base}/set-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    if model is not None:
        save_model(model, f"{folder}/{MODELS}")
    if fitted is not None:
        save_processor(spark, fitted, f"{folder}/{PROCESSORS}")
    if metrics is not None:
        save_metrics(metrics, f"{folder}/{METRICS}")
    for name, df in (tables or {}).items():
        df.write.parquet(f"{folder}/{TABLES}/{name}")
    _files(spark, folder).coalesce(1).write.json(f"{folder}/{MANIFEST}")
    return folder


def verify(spark: SparkSession, folder: str) -> None:
    """Raise ``ValueError`` unless the files are those of the manifest, byte by byte."""
    written = spark.read.schema(MANIFEST_SCHEMA).json(f"{folder}/{MANIFEST}")
    found = _files(spark, folder).withColumnRenamed("bytes", "_bytes").withColumnRenamed("md5", "_md5")
    same = (F.col("bytes") == F.col("_bytes")) & (F.col("md5") == F.col("_md5"))
    wrong = written.join(found, "path", "full").filter(~F.coalesce(same, F.lit(False)))
    paths = [r["path"] for r in wrong.select("path").limit(5).collect()]
    if paths:
        raise ValueError(f"{folder} is not what was published: {paths}")


def load_published(spark: SparkSession, base: str) -> Published:
    """The latest set that is complete; a damaged one raises ``ValueError``."""
    sets = [f for f in list_folders(spark, base) if f.startswith("set-") and file_exists(spark, f"{base}/{f}/{MANIFEST}/_SUCCESS")]
    if not sets:
        raise ValueError(f"no complete set in {base}")
    folder = f"{base}/{max(sets)}"
    verify(spark, folder)
    kinds = list_folders(spark, folder)
    return Published(
        folder,
        load_processor(spark, f"{folder}/{PROCESSORS}") if PROCESSORS in kinds else None,
        load_model(f"{folder}/{MODELS}") if MODELS in kinds else None,
    )
