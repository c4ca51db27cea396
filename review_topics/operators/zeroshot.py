"""Assignment to predefined topics by similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_topics import fixed_values as V
from review_topics.functions import vectors as X


def assign_zero_shot(
    vecs: DataFrame, prototypes: DataFrame, min_similarity: float = V.MIN_SIMILARITY, id_col: str = "idx"
) -> DataFrame:
    """``(doc_id, <id_col>, similarity)``: best topic by cosine, null below ``min_similarity``.

    The topic vectors pass by the documents tile by tile, so the pass over the documents is narrow whatever the number of
    topics: no join, no shuffle.
    """
    scored = vecs.select("doc_id", X.best_match(F.col("vec"), X.vector_tiles(prototypes, id_col)).alias("best"))
    enough = F.round("best.score", 6) >= min_similarity
    return scored.select(
        "doc_id", F.when(enough, F.col("best.id")).cast("int").alias(id_col), F.col("best.score").alias("similarity")
    )
