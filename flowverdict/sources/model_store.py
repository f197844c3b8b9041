"""Trained models as Parquet tables.

``<path>/nodes/<model_id>`` holds the trees and ``<path>/meta`` one row per saved model,
with the training statistics.  Saving only adds files (the trees of a model that is there
already are not written again), so a reader always finds a whole model; loading takes the
newest, of equally new ones the one with the largest id, or the one that is asked for.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowverdict.operators.forest import MAX_SAMPLE_ROWS, MAX_TREES, ForestModel
from flowverdict.schema import FEATURES

META_SCHEMA = (
    "model_id string, trees int, sample_rows int, seed long, threshold double, "
    "contamination double, features array<string>, "
    "stats array<struct<feature: string, min: double, max: double>>"
)


def save_model(spark: SparkSession, model: ForestModel, path: str) -> str:
    """Returns the id of the saved model, which follows from its content."""
    content = model.nodes.to_csv(index=False) + repr(sorted(model.stats.items()))
    model_id = hashlib.md5(content.encode()).hexdigest()
    nodes = model.node_frame(spark).coalesce(1)
    nodes.write.mode("ignore").parquet(f"{path}/nodes/{model_id}")
    row = (
        model_id,
        model.trees,
        model.sample_rows,
        model.seed,
        model.threshold,
        model.contamination,
        FEATURES,
        [(f, lo, hi) for f, (lo, hi) in model.stats.items()],
    )
    meta = spark.createDataFrame([row], META_SCHEMA)
    meta = meta.withColumn("saved_at", F.current_timestamp()).coalesce(1)
    meta.write.mode("append").parquet(f"{path}/meta")
    return model_id


def _read(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no saved model at {path}") from problem
        raise


def load_model(spark: SparkSession, path: str, model_id: str | None = None) -> ForestModel:
    meta = _read(spark, f"{path}/meta")
    if model_id is not None:
        meta = meta.filter(F.col("model_id") == model_id)
    meta = meta.orderBy(F.desc("saved_at"), F.desc("model_id")).first()
    if meta is None:
        raise FileNotFoundError(f"no saved model {model_id} at {path}")
    if meta.features != FEATURES:
        raise ValueError("the saved model was trained on other features")
    if meta.trees > MAX_TREES or meta.sample_rows > MAX_SAMPLE_ROWS:
        raise ValueError("the saved model is larger than a scoring task may carry")
    nodes = _read(spark, f"{path}/nodes/{meta.model_id}").orderBy("tree_id", "node_id")
    return ForestModel(
        nodes.toArrow().to_pandas(),
        meta.trees,
        meta.sample_rows,
        meta.seed,
        meta.threshold,
        meta.contamination,
        {s.feature: (s.min, s.max) for s in meta.stats},
    )
