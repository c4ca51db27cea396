"""Topics of new text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_topics.functions import vectors as X
from review_topics.operators import embedding, represent
from review_topics.plans.model import TopicModel
from review_topics.session import broadcast_checked


def predict_vectors(
    vecs: DataFrame, prototypes: DataFrame, centroids: DataFrame, min_similarity: float, other_similarity: float | None = None
) -> DataFrame:
    """``(doc_id, topic_id, probability)`` of centred vectors.

    As in the fit, a predefined topic that is close enough wins; otherwise the closest other topic does, if it is
    close enough; otherwise the document is an outlier with probability 0. One narrow pass.
    """
    other_similarity = min_similarity if other_similarity is None else other_similarity
    predefined = X.vector_tiles(prototypes, "topic_id")
    others = X.vector_tiles(centroids.where(F.col("topic_id") >= 0).join(prototypes, "topic_id", "left_anti"), "topic_id")
    topic, probability = F.lit(-1), F.lit(0.0)
    columns = ["doc_id"]
    for name, tiles, least in (("o", others, other_similarity), ("p", predefined, min_similarity)):
        if tiles:
            columns.append(X.best_match(F.col("vec"), tiles).alias(name))
            enough = F.round(F.col(f"{name}.score"), 6) >= least
            topic = F.when(enough, F.col(f"{name}.id")).otherwise(topic)
            probability = F.when(enough, F.col(f"{name}.score")).otherwise(probability)
    return vecs.select(*columns).select("doc_id", topic.cast("int").alias("topic_id"), probability.alias("probability"))


def predict(model: TopicModel, docs: DataFrame, encoder) -> DataFrame:
    """``(doc_id, topic_id, probability)`` of ``docs(doc_id, document)``."""
    vecs = embedding.centre(embedding.embed(docs, encoder), model.mean)
    return predict_vectors(
        vecs, model.prototypes, model.centroids, model.params.min_similarity, model.params.predict_similarity
    )


def predict_with_words(model: TopicModel, docs: DataFrame, encoder, n: int = 10) -> DataFrame:
    """``(doc_id, topic_id, probability, words)``: prediction beside the topic's first ``n`` keywords; outliers have none."""
    main = model.terms.where((F.col("aspect") == "Main") & (F.col("rank") <= n) & (F.col("topic_id") >= 0))
    words = broadcast_checked(represent.topic_words(main))
    return predict(model, docs, encoder).join(words, "topic_id", "left").select("doc_id", "topic_id", "probability", "words")
