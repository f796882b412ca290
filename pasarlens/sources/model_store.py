"""Saved models and their registry."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import Model
from pyspark.ml.util import DefaultParamsReader, MLWritable
from pyspark.sql import DataFrame, SparkSession

METADATA_SCHEMA = "name string, saved_at string, path string, metrics map<string,double>, notes map<string,string>"
REGISTRY_SCHEMA = "task string, model string, key_metric string, path string"


def save_model(
    spark: SparkSession,
    model: MLWritable,
    name: str,
    metrics: Mapping[str, float | None],
    root: str,
    saved_at: str,
    notes: Mapping[str, object] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> str:
    """Save under ``<root>/<name>/<name>_<saved_at>`` and add one metadata record.

    ``tables`` are what preparing new rows needs (dictionaries, vocabulary); they go next to the model.
    """
    path = f"{root}/{name}/{name}_{saved_at}"
    model.write().overwrite().save(path)
    for part, table in (tables or {}).items():
        table.write.mode("overwrite").parquet(f"{path}_{part}")
    record = (
        name,
        saved_at,
        path,
        {k: float(v) for k, v in metrics.items() if v is not None},
        {k: json.dumps(v, default=str) for k, v in (notes or {}).items()},
    )
    (
        spark.createDataFrame([record], METADATA_SCHEMA)
        .coalesce(1)
        .write.mode("overwrite")
        .json(f"{root}/_metadata/name={name}/saved_at={saved_at}")
    )
    return path


def saved_models(spark: SparkSession, root: str) -> DataFrame:
    schema = "path string, metrics map<string,double>, notes map<string,string>, name string, saved_at string"
    return spark.read.schema(schema).option("basePath", f"{root}/_metadata").json(f"{root}/_metadata")


def load_model(spark: SparkSession, path: str) -> Model:
    """Any saved model; its class is in its own metadata."""
    return DefaultParamsReader.loadParamsInstance(path, spark)


def model_registry(spark: SparkSession, rows: Sequence[Mapping[str, str]]) -> DataFrame:
    """One line per training task: task, model, key metric, path."""
    lines = [(r["task"], r["model"], r["key_metric"], r["path"]) for r in rows]
    return spark.createDataFrame(lines, REGISTRY_SCHEMA)


def write_registry(registry: DataFrame, path: str) -> None:
    registry.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).option("header", True).csv(path)
