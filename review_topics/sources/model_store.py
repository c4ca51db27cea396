"""A topic model on disk: one Parquet dataset per table and a one-row table of parameters."""

from __future__ import annotations

import json
from dataclasses import asdict

import numpy as np
from pyspark.sql import SparkSession

from review_topics.plans.model import FitParams, TopicModel


def save_model(model: TopicModel, folder: str) -> None:
    spark = model.topics.sparkSession
    for name in TopicModel.TABLES:
        getattr(model, name).write.mode("errorifexists").parquet(f"{folder}/{name}")
    row = [(json.dumps(asdict(model.params)), model.encoder_id, [float(x) for x in model.mean])]
    spark.createDataFrame(row, "params string, encoder_id string, mean array<double>").write.parquet(f"{folder}/params")


def load_model(spark: SparkSession, folder: str) -> TopicModel:
    row = spark.read.parquet(f"{folder}/params").first()
    tables = {name: spark.read.parquet(f"{folder}/{name}") for name in TopicModel.TABLES}
    return TopicModel(
        params=FitParams(**json.loads(row["params"])), encoder_id=row["encoder_id"], mean=np.array(row["mean"]), **tables
    )
