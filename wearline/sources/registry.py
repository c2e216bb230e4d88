"""Fitted classifiers: folders of Spark ML stages and a table that lists them."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline import schema
from wearline.operators.training import Classifier, TrainResult
from wearline.sources.tables import Tables


@dataclass(frozen=True)
class StoredModel:
    model_id: uuid.UUID
    name: str
    algo: str
    params: dict[str, Any]
    metrics: dict[str, Any]
    model: Classifier
    trained_on: str


def save_model(
    tables: Tables,
    model: Classifier,
    *,
    name: str,
    algo: str,
    params: dict[str, Any],
    metrics: dict[str, Any],
    trained_on: str,
) -> uuid.UUID:
    """Store ``model``, list it and return its new id. The run it was trained on must exist."""
    tables.require_run(trained_on)
    model_id = uuid.uuid4()
    uri = tables.artifact_path(str(model_id))
    model.pipeline.write().save(uri)
    listed = T.StructType([f for f in schema.MODELS if f.name != "trained_at"])
    row = (
        str(model_id),
        name,
        algo,
        json.dumps(params),
        json.dumps(metrics),
        list(model.classes),
        uri,
        trained_on,
    )
    one = tables.spark.createDataFrame([row], listed)
    tables.append_model(one.withColumn("trained_at", F.current_timestamp()))
    return model_id


def load_model(tables: Tables, model_id: uuid.UUID | str) -> StoredModel:
    """The model of that id; KeyError if there is none."""
    model_id = uuid.UUID(str(model_id))
    row = tables.models().where(F.col("model_id") == str(model_id)).first()
    if row is None:
        raise KeyError(f"no model with id {model_id}")
    return StoredModel(
        model_id=model_id,
        name=row["name"],
        algo=row["algo"],
        params=json.loads(row["params"]),
        metrics=json.loads(row["metrics"]),
        model=Classifier(PipelineModel.load(row["artifact_uri"])),
        trained_on=row["trained_on"],
    )


def write_text(spark, path: str, text: str) -> None:
    """Write a small text file to any Hadoop file system, creating its folder."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(context._jsc.hadoopConfiguration())
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def save_classifier(spark, result: TrainResult, path: str) -> None:
    """Save the pipeline to ``path`` and its metrics to ``path`` + ``.metrics.json``."""
    result.model.pipeline.write().overwrite().save(path)
    write_text(spark, f"{path}.metrics.json", json.dumps(result.metrics, indent=2))
