"""Saved embeddings: keyed rows, so vectors can be reloaded, joined and topped up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_topics.session import path_exists


def save_vectors(vecs: DataFrame, path: str, encoder_id: str) -> None:
    """Add ``(doc_id, vec)`` as floats, one folder per encoder; an id that the encoder has a vector for keeps it.

    Of several vectors of a document the smallest is saved, whatever their order; null ones are not.
    """
    rows = vecs.where(F.col("vec").isNotNull()).groupBy("doc_id").agg(F.min("vec").alias("vec"))
    if path_exists(vecs.sparkSession, path):
        saved = load_vectors(vecs.sparkSession, path, encoder_id)
        rows = rows.join(saved.select("doc_id"), "doc_id", "left_anti")
    rows.select("doc_id", F.col("vec").cast("array<float>").alias("vec"), F.lit(encoder_id).alias("encoder_id")).write.mode(
        "append"
    ).partitionBy("encoder_id").parquet(path)


def load_vectors(spark: SparkSession, path: str, encoder_id: str) -> DataFrame:
    """Vectors of one encoder; the filter prunes to its folder."""
    return (
        spark.read.parquet(path)
        .where(F.col("encoder_id") == encoder_id)
        .select("doc_id", F.col("vec").cast("array<double>").alias("vec"))
    )


def missing_vectors(docs: DataFrame, saved: DataFrame) -> DataFrame:
    """Documents that have no saved vector yet."""
    return docs.join(saved.select("doc_id"), "doc_id", "left_anti")
