"""Intents to the labelled table: fit, generate labels, reassign outliers, name every document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_topics import fixed_values as V
from review_topics.functions import text as T
from review_topics.operators import represent, reviews, topics
from review_topics.plans import fit
from review_topics.plans.model import FitParams, TopicModel
from review_topics.session import stage


def intent_documents(intents: DataFrame) -> DataFrame:
    """``(doc_id, document)``: one document per intent; an intent without text has none (see ``intents_without_text``)."""
    texts = intents.select(T.doc_text(F.col("intent"), F.col("text_summary")).alias("document")).where(F.col("document").isNotNull())
    return reviews.with_row_id(texts).select(F.col("row_id").alias("doc_id"), "document")


def intents_without_text(intents: DataFrame) -> DataFrame:
    """The intents that give no document, with a reason."""
    reason = F.when(F.col("intent").isNull(), "null_intent").when(F.col("text_summary").isNull(), "null_text_summary")
    return intents.withColumn("reason", reason).where(F.col("reason").isNotNull())


def generated_aspects(
    docs: DataFrame, model: TopicModel, encoder, provider, backoff=V.BACKOFF_SECONDS, prompt_words: int | None = None
) -> dict:
    """Keyword diversification, then a generated label; and keywords by similarity to compare with.

    ``prompt_words`` is the budget of each document in a label prompt; without it documents go in whole.
    """
    texts = model.representative.select("topic_id", "rank", "document")
    if prompt_words is not None:
        texts = reviews.truncate_tokens(texts, prompt_words)
    vecs = encoder.vectors(model.representative.select("doc_id", "document")).join(model.representative, "doc_id")

    def generated(table: DataFrame) -> DataFrame:
        return represent.llm_labels(represent.label_prompts(table, texts), provider, backoff=backoff)

    return {
        "AI_Generated": [lambda table: represent.mmr(table, encoder), generated],
        "KeyBERT": [lambda table: represent.keybert_terms(table, vecs.select("topic_id", "vec"), encoder)],
    }


def label_intents(
    intents: DataFrame,
    encoder,
    provider,
    labels: DataFrame,
    params: FitParams | None = None,
    backoff=V.BACKOFF_SECONDS,
    prompt_words: int | None = None,
) -> tuple[DataFrame, TopicModel, DataFrame]:
    """``(labelled, model, rejects)`` of an intents table: every intent is a row of ``labelled`` or of ``rejects``."""
    docs = stage(intent_documents(intents), "documents")
    model = fit.fit_topics(docs, encoder, labels, params)
    model = fit.update_topics(model, docs, encoder, model.assignments, generated_aspects(docs, model, encoder, provider, backoff, prompt_words))
    model = fit.update_topics(model, docs, encoder, fit.reduce_outliers(model, docs))
    return topics.labelled_result(model.assignments, docs, model.labels, topics.aspect_labels(model.terms)), model, intents_without_text(intents)
